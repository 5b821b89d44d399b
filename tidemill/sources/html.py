"""Extraction from page source: elements, links, ids in URLs, comment blocks."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T

VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())


def links(html: Column) -> Column:
    """All href values, in order."""
    return F.regexp_extract_all(T.text(html), F.lit(r"(?i)href\s*=\s*\"([^\"]*)\""), F.lit(1))


def paragraphs(html: Column) -> Column:
    """Trimmed texts of <p> elements that are not empty."""
    raw = F.regexp_extract_all(T.text(html), F.lit(r"(?is)<p(?:\s[^>]*)?>(.*?)</p>"), F.lit(1))
    return F.filter(F.transform(raw, lambda p: T.collapse(T.strip_tags(p))), lambda p: p != "")


def joined_paragraphs(html: Column) -> Column:
    return F.array_join(paragraphs(html), " ")


def post_id(url: Column, platform: Column) -> Column:
    """The id in a post's URL; '' where there is none."""
    digits = F.regexp_extract(url, r"(?:permalink|posts)/(\d+)", 1)
    last = F.regexp_extract(url, r"([^/?#]+)/?(?:[?#].*)?$", 1)
    found = F.when(platform == "facebook", digits).when(platform == "tiktok", last).when(platform == "youtube", F.regexp_extract(url, r"[?&]v=([^&#]*)", 1))
    return F.coalesce(found.when(platform == "reddit", F.regexp_extract(url, r"/comments/([^/?#]+)", 1)).when(platform == "threads", F.regexp_extract(url, r"/post/([^/?#]+)", 1)), F.lit(""))


class _Elements(HTMLParser):
    """Elements in document order as (path, tag, attributes, text)."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open: list[dict] = []
        self.found: list[dict] = []

    def handle_starttag(self, tag, attrs):
        element = {"tag": tag, "attrs": {k: v or "" for k, v in attrs}, "text": [], "depth": len(self.open), "parent": self.open[-1]["n"] if self.open else -1, "n": len(self.found)}
        self.found.append(element)
        if tag not in VOID:
            self.open.append(element)

    def handle_endtag(self, tag):
        if any(e["tag"] == tag for e in self.open):
            while self.open.pop()["tag"] != tag:
                pass

    def handle_data(self, data):
        for e in self.open:
            e["text"].append(data)


def elements(pages: DataFrame, key: str, tag: str, attribute: str | None = None, contains: str | None = None, html: str = "html") -> DataFrame:
    """key, n, parent, text, attribute value: the elements of a tag in document order, those whose
    attribute holds a string if given.  Broken markup is read as far as it goes; null pages have none."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for k, source in zip(frame[key], frame[html], strict=True):
                parser = _Elements()
                parser.feed(source or "")
                for e in parser.found:
                    value = e["attrs"].get(attribute or "", None)
                    if e["tag"] == tag and (attribute is None or (value is not None and (contains or "") in value)):
                        rows.append((k, e["n"], e["parent"], " ".join("".join(e["text"]).split()), value))
            yield pd.DataFrame(rows, columns=[key, "n", "parent", "text", "value"])

    kind = pages.schema[key].dataType.simpleString()
    return pages.select(key, html).mapInPandas(run, f"{key} {kind}, n long, parent long, text string, value string")


def first_of(*found: Column) -> Column:
    """The first extractor that found a text that is not blank."""
    return F.coalesce(*(F.when(T.trim(c) != "", c) for c in found))


def comment_rows(posts: DataFrame, replies: str = "replies") -> DataFrame:
    """A thread's comment, then its replies, as ordinary rows: posts has conv, author, body and an
    array of struct<author,body>."""
    own = F.array(F.struct("author", "body"))
    return posts.select("conv", F.posexplode(F.concat(own, F.coalesce(replies, F.expr("array()")))).alias("place", "c")).select("conv", "place", "c.*")


def numbered_comments(df: DataFrame, group: str, order: str, valid: Column | None = None, gaps: bool = False) -> DataFrame:
    """comment_id from the post's id and a counter: over valid rows, or over all with gaps where rows
    are not valid."""
    from pyspark.sql import Window

    w, ok = Window.partitionBy(group).orderBy(order), valid if valid is not None else F.lit(True)
    if gaps:
        return df.withColumn("comment_id", F.concat_ws("_", F.col(group).cast("string"), F.row_number().over(w).cast("string"))).where(ok)
    return df.where(ok).withColumn("comment_id", F.concat_ws("_", F.col(group).cast("string"), F.row_number().over(w).cast("string")))


def capped(df: DataFrame, group: str, order: str, most: int = 2500) -> DataFrame:
    """At most so many blocks of a post."""
    from ..operators.groups import Window

    return df.withColumn("_rk", F.row_number().over(Window.partitionBy(group).orderBy(order))).where(F.col("_rk") <= most).drop("_rk")
