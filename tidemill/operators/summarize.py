"""Summaries: distinct posts, batched model calls, join back, missing columns."""

from __future__ import annotations

import math
import time
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import rules
from ..functions import text as T

ORDER = ("post_id", "post_raw", "summary", "comment_id", "comment_raw", "created_date", "platform", "label")
#: Posts in a call, tokens in a call, attempts; first-N labels batches; output limits of a call.
BATCH, TOKENS, ATTEMPTS = 3, 4000, 3


def stub_model(posts: Sequence[str]) -> list[str]:
    """A model that needs no network: the first eight words."""
    return [" ".join(x.split()[:8]) for x in posts]


def retried(call: Callable[[], object], attempts: int = ATTEMPTS, wait: float = 0.0):
    """The call's result; None once every attempt has failed."""
    for k in range(attempts):
        try:
            return call()
        except Exception:  # a model's failure is any error; the row records it
            if k + 1 < attempts:
                time.sleep(wait * (k + 1))
    return None


def _within(posts: list[str], call: Callable[[Sequence[str]], list[str]], budget: int, attempts: int, wait: float) -> list[str | None]:
    """Halves a batch while it is over the budget; one post too long is halved itself."""
    if len(posts) > 1 and sum(max(1, len(x) // 4) for x in posts) > budget:
        half = len(posts) // 2
        return _within(posts[:half], call, budget, attempts, wait) + _within(posts[half:], call, budget, attempts, wait)
    if len(posts) == 1 and len(posts[0]) // 4 > budget:
        posts = [posts[0][: len(posts[0]) // 2]]
    said = retried(lambda: list(call(posts)), attempts, wait)
    return [None] * len(posts) if said is None else said


def map_distinct(df: DataFrame, key: str, make: Callable[[], Callable[[Sequence[str]], list[str]]] = lambda: stub_model, out: str = "summary", batch: int = BATCH, budget: int = TOKENS, attempts: int = ATTEMPTS, wait: float = 0.0, clients: int | None = None) -> DataFrame:
    """key, out: a batched call for each distinct non-null value.  make builds a client in each worker;
    clients bounds how many work at once."""
    values = df.select(key).where(F.col(key).isNotNull()).distinct()
    values = values.repartition(clients, key) if clients else values

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        call = make()
        for frame in frames:
            posts = frame[key].tolist()
            said = [s for i in range(0, len(posts), batch) for s in _within(posts[i : i + batch], call, budget, attempts, wait)]
            yield pd.DataFrame({key: posts, out: pd.Series(said, dtype=object)})

    return values.mapInPandas(run, f"{key} string, {out} string")


def join_back(df: DataFrame, summaries: DataFrame, key: str = "post_raw", out: str = "summary") -> DataFrame:
    """Every row with its post's summary: '' where the post has none, null where there is no post."""
    joined = df.drop(out).join(summaries, key, "left")
    return joined.withColumn(out, F.when(F.col(key).isNotNull(), F.coalesce(out, F.lit(""))))


def platform_of(file_name: Column) -> Column:
    out = None
    for p in rules.PLATFORMS:
        fits = F.contains(F.lower(file_name), F.lit(p))
        out = F.when(fits, p) if out is None else out.when(fits, p)
    return out.otherwise("Unknown")


def backfill(df: DataFrame, ordinal: str, file_name: Column | None = None, today: str | None = None) -> DataFrame:
    """Adds the columns that later stages need where they are missing; ordinal counts rows from 0."""
    add = {
        "post_id": F.concat(F.lit("post_"), (F.col(ordinal) + 1).cast("string")), "comment_id": F.concat(F.lit("comment_"), (F.col(ordinal) + 1).cast("string")),
        "created_date": F.lit(today) if today else F.date_format(F.current_date(), "dd-MM-yyyy"), "platform": platform_of(file_name) if file_name is not None else F.lit("Unknown"),
    }
    return df.withColumns({k: v for k, v in add.items() if k not in df.columns})


def ordered(df: DataFrame, columns: Sequence[str] = ORDER) -> DataFrame:
    """The columns that exist, in the order given; an error if none does."""
    if not (found := [c for c in columns if c in df.columns]):
        raise ValueError("none of the columns exists")
    return df.select(*found)


def report_lines(df: DataFrame) -> DataFrame:
    """One text column for a text file: each post above its summary."""
    return df.select(F.concat_ws("\n", F.lit("Original:"), T.text(F.col("post_raw")), F.lit("Summary:"), T.text(F.col("summary")), F.lit("")).alias("value"))


def call_minutes(posts: int, rpm: int, batch: int = BATCH) -> float:
    return math.ceil(posts / batch) / rpm
