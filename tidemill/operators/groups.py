"""Per-group caps, samples, chunks, dedup and sequence numbers.

Ranks are filtered by constants first, so that Spark limits each group before the shuffle: a hot group
sends at most the cap from each task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import places

SEED = 42


def hashed(key: str, seed: int = SEED) -> list[Column]:
    """A fixed pseudo-random order."""
    return [F.xxhash64(F.lit(seed), F.col(key)), F.col(key)]


def cap_per_group(df: DataFrame, group: str, order: list[Column], cap: int, priority: Column | None = None, priority_cap: int | None = None) -> DataFrame:
    """At most `cap` rows of each group, priority rows first.

    Groups within the cap pass whole.  Others keep all priority rows (at most priority_cap of them if
    given), then others up to the cap.  Rows with a null group pass only if no group is over the cap.
    """
    pri = F.coalesce(priority, F.lit(False)) if priority is not None else F.lit(False)
    rows = df.withColumn("_pri", pri)
    sizes = rows.groupBy(F.col(group).alias("_g")).agg(F.count("*").alias("_n"), F.count_if("_pri").alias("_p"))
    over = sizes.where(F.col("_g").isNotNull() & (F.col("_n") > cap)).limit(1).agg((F.count("*") > 0).alias("_over"))
    rank = F.row_number().over(Window.partitionBy(group, "_pri").orderBy(*order))
    first = rows.where(F.col("_pri")).withColumn("_rk", F.lit(0)) if priority_cap is None else rows.where(F.col("_pri")).withColumn("_rk", rank)
    rest = rows.where(~F.col("_pri")).withColumn("_rk", rank).where(F.col("_rk") <= cap)
    most = F.col("_p") if priority_cap is None else F.least(F.col("_p"), F.lit(priority_cap))
    keep = F.when(F.col("_n") <= cap, True).when(F.col("_pri"), F.col("_rk") <= most).otherwise(F.col("_rk") <= F.greatest(F.lit(0), F.lit(cap) - most))
    capped = first.union(rest).where(F.col(group).isNotNull()).join(sizes, F.col(group) == F.col("_g")).where(keep).select(*df.columns)
    loose = df.where(F.col(group).isNull()).crossJoin(over).where("not _over").select(*df.columns)  # one row on the right
    return capped.unionByName(loose)


def sample_per_group(df: DataFrame, group: str, n: int, key: str, seed: int = SEED) -> DataFrame:
    """Exactly n rows of each group (all of smaller ones), the same ones each time."""
    return df.withColumn("_rk", F.row_number().over(Window.partitionBy(group).orderBy(*hashed(key, seed)))).where(F.col("_rk") <= n).drop("_rk")


def sample(df: DataFrame, n: int, key: str, seed: int = SEED) -> DataFrame:
    return df.orderBy(*hashed(key, seed)).limit(max(1, n))


def keep_first(df: DataFrame, key: str | list[str], order: list[Column]) -> DataFrame:
    """The first row of each key; null is a key."""
    keys = [key] if isinstance(key, str) else key
    return df.withColumn("_rk", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_rk = 1").drop("_rk")


def top(df: DataFrame, order: list[Column], n: int = 3) -> DataFrame:
    return df.orderBy(*order).limit(n)


def tail(df: DataFrame, key: str, n: int = 5) -> DataFrame:
    """The last n rows by a key, in its order."""
    return df.orderBy(F.desc(key)).limit(n).orderBy(key)


def sequence(df: DataFrame, group: str, order: list[Column], name: str = "seq") -> DataFrame:
    """1, 2, ... inside each group."""
    return places.sequence(df, group, order, name)


def chunks(df: DataFrame, group: str, order: list[Column], size: int, name: str = "batch") -> DataFrame:
    """Batches of `size` rows inside each group, numbered from 0."""
    return places.chunks(df, order, size, group, name)


def distinct_first_seen(df: DataFrame, column: str, order: str) -> DataFrame:
    """Distinct non-null values with the first place of each."""
    return df.where(F.col(column).isNotNull()).groupBy(column).agg(F.min(order).alias("first_seen"))


def group_size(df: DataFrame, group: str, name: str = "group_size") -> DataFrame:
    """Each row with its group's size; sums are made before rows meet."""
    return df.join(df.groupBy(group).agg(F.count("*").alias(name)), group, "left")
