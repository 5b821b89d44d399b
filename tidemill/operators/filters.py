"""Row filters of the curation stages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T


def require(df: DataFrame, *columns: str) -> DataFrame:
    """df, or an error that names the columns it lacks."""
    if missing := [c for c in columns if c not in df.columns]:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def long_flag(c: Column, max_words: int = 300) -> Column:
    return T.count_words(c) > max_words


def filter_long(df: DataFrame, max_words: int = 300, column: str = "comment_raw") -> tuple[DataFrame, DataFrame]:
    """Kept and removed rows over one tagged plan; the raw text's words decide."""
    tagged = df.withColumn("word_count_temp", T.count_words(F.col(column)))
    gone = tagged.where(F.col("word_count_temp") > max_words).withColumn("removal_reason", F.lit(f"Comment longer than {max_words} words"))
    return tagged.where(F.col("word_count_temp") <= max_words).drop("word_count_temp"), gone


def clamp(value: int | None, least: int) -> int | None:
    """A threshold from a user: None skips the step, else at least so much."""
    return None if value is None else max(least, value)


def short_flag(c: Column, literals: Sequence[str] = (), least: int = 3) -> Column:
    """Too short: no more than `least` words and no special literal; true for null."""
    return ~((T.count_words(c) > least) | T.special(c, literals)) | c.isNull()


def filter_short(df: DataFrame, literals: Sequence[str] = (), column: str = "comment_clean") -> tuple[DataFrame, DataFrame]:
    tagged = df.withColumn("_short", short_flag(F.col(column), literals))
    return tagged.where("not _short").drop("_short"), tagged.where("_short").drop("_short").withColumn("removal_reason", T.removal_reason(F.col(column)))


def present(df: DataFrame, *columns: str) -> DataFrame:
    return df.dropna(subset=list(columns))


def by_label(df: DataFrame, value: str) -> DataFrame:
    return df.where(F.col("label") == value)


def short_view(c: Column, tokens: int = 5) -> Column:
    """Fewer than so many tokens; missing text counts as short."""
    return F.coalesce(c.isNull() | (T.count_tokens(c) < tokens), F.lit(True))


def search(c: Column, query: str | None) -> Column:
    """Text that contains the query, ignoring case; missing text never; no query means all."""
    return F.coalesce(F.contains(F.lower(c), F.lit(query.lower())), F.lit(False)) if query else F.lit(True)


def unflagged(df: DataFrame) -> DataFrame:
    return df.where(~F.col("delete_flag"))


def valid_labels(c: Column, labels: Sequence[str]) -> Column:
    return F.coalesce(c.isin(*labels), F.lit(False))


def not_blank(c: Column) -> Column:
    return F.length(T.trim(T.text(c))) > 0


def candidate(body: Column, has_time: Column, has_link: Column) -> Column:
    """An element that may be a comment."""
    return F.coalesce((F.length(body) > 10) & (has_time | has_link), F.lit(False))


def summarised(c: Column, failures: Sequence[str]) -> Column:
    """A summary that is there and holds no failure text."""
    out = F.length(T.text(c)) > 0
    for f in failures:
        out &= ~F.contains(T.text(c), F.lit(f))
    return out
