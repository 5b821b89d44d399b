"""Batches, capacity and feasibility of model calls, and quotas over a request log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import rules
from . import places

#: Tokens of a comment and of a batch beyond its comments.
COMMENT_TOKENS, BATCH_TOKENS = 35, 500


def models(spark) -> DataFrame:
    return spark.createDataFrame(list(rules.QUOTAS), "model string, rpm int, rpd int, tpm int")


def batches(df: DataFrame, size: int, group: str | None = "summary") -> DataFrame:
    """One row: batches of `size` rows, inside each group where df has it (null groups have none)."""
    if group in df.columns:
        return df.where(F.col(group).isNotNull()).groupBy(group).count().agg(F.coalesce(F.sum(F.ceil(F.col("count") / size)), F.lit(0)).alias("batches"))
    return df.agg(F.ceil(F.count("*") / size).alias("batches"))


def capacity(df: DataFrame, model: str, keys: int, size: int = 50, group: str | None = "summary") -> DataFrame:
    """One row of twelve figures: rows, batches, a size that fits the tokens of a minute, quotas over all
    keys, time, feasibility, what stands in the way, and what to do about it."""
    quotas = {m: (rpm, rpd, tpm) for m, rpm, rpd, tpm in rules.QUOTAS}
    rpm, rpd, tpm = (x * keys for x in quotas.get(model, quotas[rules.DEFAULT_MODEL]))
    if tpm // (COMMENT_TOKENS * size + BATCH_TOKENS) < rpm:
        size = max(10, (tpm // rpm) // COMMENT_TOKENS)
    effective = int(rpm * 0.9)
    n = F.col("batches").cast("long")
    minutes = n / F.lit(float(effective))
    feasible = (n <= rpd) & F.lit(rpm >= 6)
    none = F.array().cast("array<string>")
    return df.agg(F.count("*").alias("total_comments")).crossJoin(batches(df, size, group)).select(  # one row each
        "total_comments", F.col("batches").alias("estimated_batches"), F.lit(size).alias("adjusted_batch_size"), F.lit(rpm).alias("total_rpm_capacity"), F.lit(tpm).alias("total_tpm_capacity"),
        F.lit(rpd).alias("total_rpd_capacity"), F.lit(effective).alias("effective_rpm"), minutes.alias("estimated_minutes"), (minutes / 60 * 1.1).alias("estimated_hours"),
        feasible.alias("is_feasible"), F.when(feasible, none).otherwise(F.array(F.concat(F.lit("RPD limit: "), n.cast("string"), F.lit(f" > {rpd}")))).alias("capacity_issues"),
        F.when(feasible, none).otherwise(F.array(F.lit("Split processing across multiple days"))).alias("recommendations"),
    )


def feasibility(df: DataFrame, keys: int, size: int = 50, group: str | None = "summary") -> DataFrame:
    """Each model of the quota table against the table's batches."""
    rows = batches(df, size, group).crossJoin(models(df.sparkSession))  # one row by eight
    rpm = F.col("rpm") * keys
    return rows.select("model", "batches", F.greatest(F.lit(0.1), F.col("batches") / rpm / 60).alias("hours"), ((rpm >= 10) & (F.col("tpm") * keys >= 100000) & (F.col("batches") <= F.col("rpd") * keys)).alias("feasible"))


def quota_windows(requests: DataFrame, per_minute: int, per_day: int, key: str = "key", ts: str = "ts", order: str = "id") -> DataFrame:
    """Each request with its place in its key's minute and day, and whether both quotas admit it.  A busy key
    is spread over tasks."""
    rows = requests.withColumns({"_minute": F.date_trunc("minute", ts), "_day": F.date_trunc("day", ts)})
    rows = places.sequences(rows, [F.col(key), F.col(ts), F.col(order)], {"in_minute": [key, "_minute"], "in_day": [key, "_day"]}).drop("_minute", "_day")
    return rows.withColumn("admitted", (F.col("in_minute") <= per_minute) & (F.col("in_day") <= per_day))


def quota_gaps(requests: DataFrame, per_minute: int, key: str = "key", ts: str = "ts", order: str = "id", gap_s: int = 60) -> DataFrame:
    """The other model of a minute: its count starts anew after so many seconds without a request."""
    by = [F.col(ts), F.col(order)]
    seconds = F.unix_micros(F.col(ts).cast("timestamp")) / 1e6
    rows = places.previous(requests, by, key, seconds, "_before")
    rows = rows.withColumn("_new", F.coalesce((seconds - F.col("_before") >= gap_s).cast("int"), F.lit(0)))
    rows = places.running(rows, by, key, F.col("_new"), "burst").withColumn("burst", F.col("burst") + F.col("_new")).drop("_before", "_new")
    rows = places.sequences(rows, [F.col(key), *by], {"in_burst": [key, "burst"]})
    return rows.withColumn("admitted", F.col("in_burst") <= per_minute)
