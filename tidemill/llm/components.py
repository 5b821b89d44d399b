"""Connected components of an edge table, by star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import stage


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, component (the smallest node it reaches) for every node of an edge.

    Rounds of large-star and small-star steps, each two aggregations and joins on node ids.  Hot nodes
    are minima under partial aggregation and joins that Spark can split; every round is written to the
    shared folder, and only a count and a checksum reach the driver.  Edges with a null end are left
    out; self-edges and repeats do no harm; no edges give no rows.
    """
    own = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"), F.col(a).alias("_a"), F.col(b).alias("_b")).where("_a is not null and _b is not null").select("u", "v")
    now = stage(own.distinct(), "edges")
    before = None
    while True:
        both = now.where("u <> v")
        both = both.union(both.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v")))
        now = stage(small.distinct(), "edges")
        mark = tuple(now.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())
        if mark == before or not mark[0]:
            break
        before = mark
    nodes = own.select(F.col("u").alias("node")).union(own.select(F.col("v").alias("node"))).distinct()
    return nodes.join(now.select(F.col("u").alias("node"), F.col("v").alias("_m")), "node", "left").select("node", F.coalesce("_m", "node").alias("component"))
