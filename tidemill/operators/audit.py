"""Audit of labels: an edit log applied to a table, views, export."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from . import filters
from .summarize import ORDER, ordered


def text_labels(c: Column, names: dict[int, str], default: str) -> Column:
    """Numeric labels by name, others as text, a default for null."""
    pairs = [F.lit(x) for k, v in names.items() for x in (str(k), v)]
    return F.coalesce(F.create_map(*pairs)[c.cast("string")], c.cast("string"), F.lit(default)) if pairs else F.coalesce(c.cast("string"), F.lit(default))


def prepare(df: DataFrame, names: dict[int, str], default: str) -> DataFrame:
    """Adds delete_flag and label where they are missing, and names numeric labels."""
    label = text_labels(F.col("label"), names, default) if "label" in df.columns else F.lit(default)
    return df.withColumns({"label": label, "delete_flag": F.coalesce("delete_flag", F.lit(False)) if "delete_flag" in df.columns else F.lit(False)})


def apply_edits(df: DataFrame, edits: DataFrame, key: str) -> DataFrame:
    """df after an edit log (key, action, value, seq): 'label' and 'text' set values, 'flag', 'unflag'
    and 'toggle' change delete_flag.  The last of each kind wins; toggles after the last flag or unflag
    count by parity."""
    flag = F.col("action").isin("flag", "unflag")
    last = edits.groupBy(key).agg(
        F.max_by("value", F.when(F.col("action") == "label", F.col("seq"))).alias("_label"), F.max_by("value", F.when(F.col("action") == "text", F.col("seq"))).alias("_text"),
        F.max_by("action", F.when(flag, F.col("seq"))).alias("_flag"), F.max(F.when(flag, F.col("seq"))).alias("_at"),
    )
    toggles = edits.where(F.col("action") == "toggle").join(last.select(key, "_at"), key).where(F.col("_at").isNull() | (F.col("seq") > F.col("_at"))).groupBy(key).agg(F.count("*").alias("_toggles"))
    rows = df.join(last, key, "left").join(toggles, key, "left")
    base = F.when(F.col("_flag").isNotNull(), F.col("_flag") == "flag").otherwise(F.col("delete_flag"))
    odd = F.coalesce(F.col("_toggles"), F.lit(0)) % 2 == 1
    return rows.withColumns({"label": F.coalesce("_label", "label"), "comment_raw": F.coalesce("_text", "comment_raw"), "delete_flag": base != odd}).select(*df.columns)


def flag_post(df: DataFrame, picked: DataFrame, post: str = "post_raw") -> DataFrame:
    """Flags every comment of the posts of the picked rows; a missing post flags nothing."""
    posts = picked.select(F.col(post).alias("_post")).where("_post is not null").distinct().withColumn("_hit", F.lit(True))
    return df.join(posts, F.col(post) == F.col("_post"), "left").withColumn("delete_flag", F.col("delete_flag") | F.coalesce("_hit", F.lit(False))).select(*df.columns)


def view(df: DataFrame, label: str | None = None, short: bool = False, query: str | None = None) -> DataFrame:
    """Rows that a view shows: by label, only short ones, by text; all conditions hold together."""
    keep = filters.search(F.col("comment_raw"), query)
    if label:
        keep &= F.col("label") == label
    if short:
        keep &= filters.short_view(F.col("comment_raw"))
    return df.where(keep)


def display(df: DataFrame, key: str) -> DataFrame:
    """What a line of the view shows."""
    return df.select(
        key, F.coalesce(F.col("comment_raw"), F.lit("[NO TEXT]")).alias("comment"), "label", F.when(F.col("delete_flag"), "x").otherwise("").alias("mark"),
        (F.coalesce("platform", F.lit("Unknown")) if "platform" in df.columns else F.lit("Unknown")).alias("platform"), T.count_tokens(F.col("comment_raw")).alias("words"),
        F.when(F.col("delete_flag"), "deleted").otherwise(F.col("label")).alias("style"),
    )


def stats(df: DataFrame, labels: tuple[str, ...]) -> DataFrame:
    return df.agg(F.count("*").alias("total"), *(F.count_if(F.col("label") == x).alias(f"n_{i}") for i, x in enumerate(labels)), F.count_if("delete_flag").alias("flagged"))


def export(df: DataFrame) -> DataFrame:
    """Rows that are not flagged, in the final order of columns."""
    return ordered(filters.unflagged(df).drop("delete_flag"), ORDER)
