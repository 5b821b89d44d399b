"""Mixing sources to target weights along a time-varying curriculum."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import ranked, word_count

#: Hash buckets of a source: each is a separate piece of its stream, so a hot source fills no task.
BUCKETS = 4096
#: Weight of a source by its place in code-point order, repeating.
WEIGHTS = (1.0, 2.0, 3.0)
#: How the weight of each class runs over equal phases of training; each row has mean 1.
PHASES = ((1.5, 1.0, 0.5), (1.0, 1.0, 1.0), (0.5, 1.0, 1.5))
MAX_REPEAT = 3
ADDED = ("size", "source_size", "target", "positions")


def targets(sources: DataFrame, weights=WEIGHTS, phases=PHASES, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """sources: _none, _src, source_size (long).  Adds target and the schedule's running integral _cum.

    A source's target is its weight's share of all sizes, at most max_repeat times its own size; the
    excess goes to the others by weight until none is above.  The level per unit of weight is found by
    repeated sums over the source table: only three numbers a round reach the driver.
    """
    rows = ranked(sources, [F.col("_none"), F.col("_src")], "sources", "_place")
    cls = F.pmod(F.col("_place"), F.lit(len(weights)))
    weight = F.element_at(F.array(*map(F.lit, map(float, weights))), (cls + 1).cast("int"))
    cum = []
    for w, phase in zip(weights, phases, strict=True):
        total, run = sum(phase), 0.0
        part = [0.0]
        for x in phase:
            run += x / total
            part.append(run)
        cum.append(F.array(*map(F.lit, [*part[:-1], 1.0])))
    rows = rows.withColumns({"_w": weight, "_cum": F.element_at(F.array(*cum), (cls + 1).cast("int"))})
    cap = F.col("source_size") * F.lit(max_repeat)
    total = rows.agg(F.sum("source_size")).first()[0] or 0
    level, before = 0.0, None
    while True:
        full = (cap < F.col("_w") * F.lit(level)) if before is not None else F.lit(False)
        capped, n, free = rows.agg(F.sum(F.when(full, cap).otherwise(0)), F.sum(full.cast("long")), F.sum(F.when(full, 0.0).otherwise(F.col("_w")))).first()
        if n == before or not free:
            break
        level, before = (total - capped) / free, n
    target = F.least(cap.cast("double"), F.col("_w") * F.lit(level))
    return rows.select("_none", "_src", "source_size", target.alias("target"), "_cum")


def curriculum(docs: DataFrame, source_col: str = "source", text_col: str = "text", id_col: str = "doc_id", weights=WEIGHTS, phases=PHASES, max_repeat: int = MAX_REPEAT, buckets: int = BUCKETS) -> DataFrame:
    """All rows of docs with size, source_size, target and positions (array<double>, one a taken copy).

    Each source's documents form a stream in hash order; copy k of a document starts k whole streams
    after its first.  A copy is taken while its middle lies within the source's target.  Its training
    position in [0, 1] is where the integral of the source's weight schedule reaches that share of the
    target: demand, inverted.  The stream is cut into hash buckets, whose sums give every bucket its
    start, so the running sum inside a bucket is all that a task sees.

    Null text has size 0; null source is one source, last in order; null ids and repeated rows are
    rows like any other; empty tables stay empty; columns of docs named like the added ones are replaced.
    """
    kept = [c for c in docs.columns if c not in ADDED]
    names = {c: f"_c{i}" for i, c in enumerate(kept)}  # columns of any name go through
    missing = [c for c in (source_col, text_col, id_col) if c not in names]
    if missing:
        raise ValueError(f"no columns {missing}")
    docs = docs.select(*(F.col(f"`{c}`").alias(n) for c, n in names.items()))
    source_col, text_col, id_col = names[source_col], names[text_col], names[id_col]
    key = {"_none": F.col(source_col).isNull(), "_src": F.coalesce(F.col(source_col).cast("string"), F.lit("")), "size": word_count(F.col(text_col)), "_h": F.xxhash64(F.col(id_col))}
    rows = docs.withColumns(key).withColumn("_b", F.pmod(F.col("_h"), F.lit(buckets)).cast("int"))
    sums = rows.groupBy("_none", "_src", "_b").agg(F.sum("size").alias("_bsize"))
    sources = targets(sums.groupBy("_none", "_src").agg(F.sum("_bsize").alias("source_size")), weights, phases, max_repeat)
    run = Window.partitionBy("_none", "_src").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.withColumn("_start", F.coalesce(F.sum("_bsize").over(run), F.lit(0))).join(sources, ["_none", "_src"]).drop("_bsize")
    inside = Window.partitionBy("_none", "_src", "_b").orderBy("_h", F.asc_nulls_last(id_col), "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("_before", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(starts, ["_none", "_src", "_b"])
    placed = placed.withColumn("_mid", F.col("_start") + F.col("_before") + F.col("size") / F.lit(2.0))
    mids = F.filter(F.transform(F.sequence(F.lit(0), F.lit(max_repeat - 1)), lambda k: F.col("_mid") + k * F.col("source_size")), lambda m: m <= F.col("target"))
    phase_count = len(phases[0])

    def when_reached(mid):
        share = F.when(F.col("target") > 0, mid / F.col("target")).otherwise(F.lit(0.0))
        place = F.least(F.size(F.filter(F.col("_cum"), lambda c: c <= share)), F.lit(phase_count))
        low, high = F.element_at("_cum", place), F.element_at("_cum", place + 1)
        return F.least(F.lit(1.0), (place - 1 + F.when(high > low, (share - low) / (high - low)).otherwise(F.lit(0.0))) / F.lit(phase_count))

    placed = placed.withColumn("positions", F.transform(mids, when_reached))
    return placed.select(*(F.col(n).alias(c) for c, n in names.items()), "size", "source_size", "target", "positions")


def training_order(mixed: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row per taken copy, range-sorted by training position."""
    copies = mixed.withColumn("position", F.explode("positions")).drop("positions")
    return copies.repartitionByRange("position", id_col).sortWithinPartitions("position", id_col)


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed corpus: the columns of docs, one row per taken copy, in training order.  Edge cases as
    in curriculum()."""
    names = [f"_c{i}" for i in range(len(docs.columns))]
    of = dict(zip(docs.columns, names, strict=True))
    mixed = curriculum(docs.toDF(*names), of["source"], of["text"], of["doc_id"], **options)
    return training_order(mixed, of["doc_id"]).select(*names).toDF(*docs.columns)
