"""Exact dedup by content sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import stage, without_space

#: Characters of the normalised text that splitters hold: what the driver samples stays small.
PREFIX = 32
#: A text with more rows than PIECE, or than one in SHARES of all rows where that is more, is sorted in
#: pieces of about so many rows; so at most SHARES texts are cut up.
PIECE, SHARES = 512, 100_000


def keyed(rows: DataFrame, norm: Column) -> DataFrame:
    """Adds the sort key of the content: a prefix and a hash of the normalised text, which place different
    texts apart, and a number of each row.  The full text follows in the sort itself."""
    return rows.withColumns({"_prefix": F.substring(norm, 1, PREFIX), "_hash": F.xxhash64(norm), "_row": F.monotonically_increasing_id()})


def content_order(rows: DataFrame, id_col: str, norm: Column, piece: int = PIECE) -> DataFrame:
    """rows: a table of keyed() with _n.  Range-partitions them by sampled splitters and sorts each
    partition by content, which places equal texts side by side; numbers the rows of each run of equal
    neighbours, compared in full (_rn), with the run's size and its first row.

    The range partitioning by (prefix, hash, piece) also clusters (prefix, hash, text, piece), so the
    window has no exchange of its own, and its sort puts the pieces of one text next to each other.
    """
    limit = max(piece, -(-rows.count() // SHARES))
    hot = rows.groupBy("_hash").agg(F.count("*").alias("_many")).where(F.col("_many") > limit)  # SHARES rows at most
    rows = rows.join(F.broadcast(hot), "_hash", "left")
    rows = rows.withColumn("_piece", F.when(F.col("_many").isNull(), 0).otherwise(F.pmod(F.xxhash64("_row"), F.ceil(F.col("_many") / limit))).cast("int"))
    rows = rows.repartitionByRange("_prefix", "_hash", "_piece").withColumn("_norm", norm)
    run = Window.partitionBy("_prefix", "_hash", "_norm", "_piece").orderBy(F.desc("_n"), F.asc_nulls_last(id_col), "_row")
    whole = run.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return rows.withColumns({
        "_rn": F.row_number().over(run), "_run": F.first("_row").over(whole), "_head": F.first(id_col).over(whole),
        "_head_n": F.first("_n").over(whole), "_cnt": F.count(F.lit(1)).over(whole),
    })


def _stitched(runs: DataFrame) -> DataFrame:
    """Joins the pieces of one text, whole texts compared: _run to the survivor's id and run and the size.
    _edge is the text of the first row of each piece of a text that was cut up."""
    best = Window.partitionBy("_hash", "_edge").orderBy(F.desc("_head_n"), F.asc_nulls_last("_head"), "_run")
    whole = best.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return runs.where("_edge is not null").select("_run", F.first("_head").over(whole).alias("_keep"), F.first("_run").over(whole).alias("_keep_run"), F.sum("_cnt").over(whole).alias("_size"))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", piece: int = PIECE) -> DataFrame:
    """One row per input row: the id, keep_id, group_size, kept and text_sha256.

    Texts are equal when identical without white space; of equal texts the one with the most code
    points, then the smallest id, stays.  Sampled splitters range-partition the normalised text,
    Spark's external sort places equals adjacent, and the window compares whole neighbouring texts.
    A text with very many rows is sorted in neighbouring pieces, whose first rows are compared in full.

    Null text is empty text; a null id sorts after others; of rows alike in id and text exactly one is
    kept; an empty table gives an empty result; other columns are ignored.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col), F.char_length(text).cast("long").alias("_n"), without_space(F.col(text_col)).alias("_norm"))
    ordered = content_order(stage(keyed(rows, F.col("_norm")), "content"), id_col, F.col("_norm"), piece)
    edge = F.when(F.col("_many").isNotNull() & (F.col("_rn") == 1), F.col("_norm"))
    runs = stage(ordered.select(id_col, "_hash", "_many", "_rn", "_run", "_head", "_head_n", "_cnt", edge.alias("_edge"), F.sha2("_norm", 256).alias("text_sha256")), "runs")
    light = runs.where("_many is null").select(id_col, F.col("_head").alias("keep_id"), F.col("_cnt").alias("group_size"), (F.col("_rn") == 1).alias("kept"), "text_sha256")
    hot = runs.where("_many is not null").drop("_edge").join(_stitched(runs), "_run")
    return light.union(hot.select(id_col, "_keep", "_size", (F.col("_rn") == 1) & (F.col("_run") == F.col("_keep_run")), "text_sha256"))


def drop_exact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", piece: int = PIECE) -> DataFrame:
    """The surviving rows of docs with all their columns; rules and edge cases as in exact_groups()."""
    names = [f"_c{i}" for i in range(len(docs.columns))]
    new_id, new_text = names[docs.columns.index(id_col)], names[docs.columns.index(text_col)]
    norm = without_space(F.col(new_text))
    rows = keyed(docs.toDF(*names).withColumn("_n", F.char_length(F.coalesce(F.col(new_text), F.lit(""))).cast("long")), norm)
    firsts = content_order(stage(rows, "content"), new_id, norm, piece).where("_rn = 1")
    runs = stage(firsts.withColumn("_edge", F.when(F.col("_many").isNotNull(), F.col("_norm"))).drop("_norm", "_prefix"), "runs")
    kept = _stitched(runs).where("_run = _keep_run").select("_run")
    hot = runs.where("_many is not null").join(kept, "_run", "left_semi")
    return runs.where("_many is null").select(*names).union(hot.select(*names)).toDF(*docs.columns)
