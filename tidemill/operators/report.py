"""Reports as small aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T

#: Comments of a post, by size; 1001 belongs to the last.
BUCKETS = (("1-10", 1, 10), ("11-50", 11, 50), ("51-100", 51, 100), ("101-500", 101, 500), ("501-1000", 501, 1000), (">1000", 1001, None))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))


def shares(df: DataFrame, column: str) -> DataFrame:
    """Counts of each value with percent of all rows, sorted by value."""
    out = df.groupBy(column).agg(F.count("*").alias("n"))
    return out.withColumn("percent", F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy())).orderBy(column)


def word_stats(df: DataFrame, column: str) -> DataFrame:
    n = T.count_words(F.col(column))
    return df.agg(F.count("*").alias("n"), F.min(n).alias("least"), F.max(n).alias("most"), F.avg(n).alias("mean"), F.percentile(n, F.lit(0.5)).alias("median"))


def group_stats(df: DataFrame, group: str) -> DataFrame:
    """Mean, largest, least and median rows of a group."""
    n = F.col("n")
    return value_counts(df, group).agg(F.count("*").alias("groups"), F.avg(n).alias("mean"), F.max(n).alias("most"), F.min(n).alias("least"), F.percentile(n, F.lit(0.5)).alias("median"))


def histogram(df: DataFrame, group: str) -> DataFrame:
    """Groups by size; empty buckets appear."""
    n, label = F.col("n"), None
    for name, low, high in BUCKETS:
        fits = (n >= low) & (n <= high) if high else n >= low
        label = F.when(fits, name) if label is None else label.when(fits, name)
    found = value_counts(df, group).groupBy(label.alias("bucket")).agg(F.count("*").alias("k"))
    names = df.sparkSession.createDataFrame([(i, b[0]) for i, b in enumerate(BUCKETS)], "place int, bucket string")
    return names.join(found, "bucket", "left").select("place", "bucket", F.coalesce("k", F.lit(0)).alias("groups"))


def consistency(df: DataFrame, text_col: str, id_col: str) -> DataFrame:
    a, b = F.count_distinct(text_col), F.count_distinct(id_col)
    return df.agg(a.alias("texts"), b.alias("ids"), (a == b).alias("same"))


def retention(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows before and after with percents; null percents for an empty table."""
    rows = before.agg(F.count("*").alias("before")).crossJoin(after.agg(F.count("*").alias("after")))  # one row each
    return rows.withColumns({"removed": F.col("before") - F.col("after"), "retained_percent": F.try_divide(F.col("after") * 100.0, F.col("before"))})


def changed(df: DataFrame, before: Column, after: Column) -> DataFrame:
    return df.agg(F.count_if(~before.eqNullSafe(after)).alias("changed"))


def duplicates(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.count("*").alias("n"), (F.count("*") - F.count_distinct(column) - (F.count("*") > F.count(column)).cast("int")).alias("duplicates"))


def profile(df: DataFrame) -> DataFrame:
    """name, type, non_null of each column, and the rows."""
    counts = df.agg(F.count("*").alias("rows"), *(F.count(F.col(f"`{c}`")).alias(f"_{i}") for i, c in enumerate(df.columns)))
    entries = F.array(*(F.struct(F.lit(c).alias("name"), F.lit(t).alias("type"), F.col(f"_{i}").alias("non_null")) for i, (c, t) in enumerate(df.dtypes)))
    return counts.select("rows", F.explode(entries).alias("x")).select("x.*", "rows")


def reasons(df: DataFrame, **flags: Column) -> DataFrame:
    """How many rows each condition meets."""
    return df.agg(*(F.count_if(c).alias(k) for k, c in flags.items()))
