"""Whole stages as single plans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import filters, groups
from ..rules import RuleSet
from ..sources import tables


def first_stage(df: DataFrame, rules: RuleSet, order: list[Column], max_words: int | None = 300, cap: int | None = None, priority_cap: int | None = None, post: str = "post_id", key: str = "comment_id", normalise: bool = False) -> tuple[DataFrame, DataFrame]:
    """Kept rows with their cleaned comment_raw, and removed rows with removal_reason.

    Long texts go by their raw words, short ones by their cleaned words, then posts are capped.  key
    identifies a row in the cap's difference.
    """
    tagged = df.withColumn("_long", filters.long_flag(F.col("comment_raw"), max_words) if max_words is not None else F.lit(False))
    tagged = tagged.withColumn("_clean", F.when(~F.col("_long"), T.minimal_clean(F.col("comment_raw"), normalise)))  # long texts go as they are
    reason = F.when(F.col("_long"), f"Comment longer than {max_words} words").when(filters.short_flag(F.col("_clean"), rules.keep), T.removal_reason(F.col("_clean")))
    tagged = tagged.withColumn("removal_reason", reason).drop("_long")
    if cap is not None:  # what is cleaned is looked at several times below
        tagged = tables.staged(tagged, "cleaned")
    removed = tagged.where("removal_reason is not null").drop("_clean")
    kept = tagged.where("removal_reason is null").withColumn("comment_raw", F.col("_clean")).select(*df.columns)
    if cap is None:
        return kept, removed
    within = groups.cap_per_group(kept, post, order, cap, T.contains_any(F.col("comment_raw"), rules.priority), priority_cap)
    over = kept.join(within.select(key), key, "left_anti").where(F.col(post).isNotNull()).withColumn("removal_reason", F.lit(f"Balanced - exceeded max {cap} comments per post"))
    return within, removed.unionByName(over, allowMissingColumns=True)


def final_stage(df: DataFrame, order: list[Column], lexicon: tuple[tuple[str, str], ...] = (), normalise: bool = False, column: str = "comment_raw") -> DataFrame:
    """comment_clean by the seven steps, the first row of each cleaned text kept."""
    cleaned = df.withColumn("comment_clean", F.when(F.col(column).isNotNull(), T.seven_step(F.col(column), lexicon, normalise)))
    return groups.keep_first(cleaned, "comment_clean", order)
