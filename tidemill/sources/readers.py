"""Readers of scraped comments and of stage files."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .. import rules
from ..operators import places

SCRAPED = ("post_id", "post_raw", "comment_id", "author", "created_date", "comment_raw")


def _schema(names: tuple[str, ...]) -> StructType:
    return StructType([StructField(n, StringType()) for n in names])


def field_count(record: Column) -> Column:
    """Fields of one CSV record: its commas outside quotes, and one."""
    return F.regexp_count(F.regexp_replace(record, r'"[^"]*+"', ""), F.lit(",")) + 1


def read_scraped(spark: SparkSession, path: str | list[str], strict: bool = True, glob: str = "*", fail: bool = False) -> DataFrame:
    """The six columns of scraped CSV files, with the file's name as file_name.

    The time column is created_date under either name.  strict drops rows with fewer than six fields, as
    they were written: an empty last cell is a field.  Cells beyond six are ignored.  The reader hands over
    the text of records of any other width, whose fields are then counted.  fail raises an error at a file
    that can't be read as UTF-8 text instead of reading on.
    """
    names = StructType([*_schema(SCRAPED).fields, StructField("_record", StringType())])
    rows = spark.read.csv(path, schema=names, header=True, multiLine=True, escape='"', mode="PERMISSIVE", enforceSchema=True, columnNameOfCorruptRecord="_record", pathGlobFilter=glob)
    rows = rows.withColumn("file_name", F.col("_metadata.file_name"))
    if fail:
        broken = F.exists(F.array(*SCRAPED), lambda c: F.contains(c, F.lit("\ufffd")))
        rows = rows.where(F.when(broken, F.raise_error(F.concat(F.col("file_name"), F.lit(" is not UTF-8 text"))).cast("boolean")).otherwise(True))
    wide = F.col(SCRAPED[-1]).isNotNull() | F.col("_record").isNull() | (field_count(F.col("_record")) >= len(SCRAPED))
    return (rows.where(wide) if strict else rows).select(*SCRAPED, "file_name")


def read_stage(spark: SparkSession, path: str, na_values: tuple[str, ...] = rules.NA_VALUES) -> DataFrame:
    """A stage's table from Parquet, or from CSV with a header and a reader's missing values."""
    if path.rstrip("/").endswith(".parquet"):
        return unified(spark.read.parquet(path))
    rows = spark.read.csv(path, header=True, multiLine=True, escape='"')
    return unified(rows.select(*(F.when(F.col(f"`{c}`").isin(*na_values), None).otherwise(F.col(f"`{c}`")).alias(c) for c in rows.columns)))


def unified(df: DataFrame) -> DataFrame:
    """created_time and created_date as the one column created_date."""
    if "created_time" not in df.columns:
        return df
    both = F.coalesce("created_date", "created_time") if "created_date" in df.columns else F.col("created_time")
    return df.withColumn("created_date", both).drop("created_time")


def read_excel(spark: SparkSession, path: str) -> DataFrame:
    """The first sheet of a workbook, read by the driver where a reader library is there."""
    import pandas as pd

    frame = pd.read_excel(path, dtype=str)
    return unified(spark.createDataFrame(frame.where(frame.notna(), None)))


def fix_breaks(c: Column) -> Column:
    """CR to LF, then one pass that makes one of two line breaks."""
    return F.replace(F.replace(c, F.lit("\r"), F.lit("\n")), F.lit("\n\n"), F.lit("\n"))


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """Whole text files with their line breaks mended, as a clipboard would give them."""
    return spark.read.text(path, wholetext=True).select(fix_breaks(F.col("value")).alias("value"))


def spread(df: DataFrame) -> DataFrame:
    """A scan of fewer pieces than there are cores, dealt out to all of them: text functions are worth the
    shuffle.  Larger inputs have pieces enough and stay as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def stage_path(root: str, version: str, stage: str, file: str = "") -> str:
    return "/".join(x for x in (root.rstrip("/"), version, stage, file) if x)


def with_ordinal(df: DataFrame, *order: str) -> DataFrame:
    """_ord from a key that sorts rows; straight after a scan of a fixed layout, none is needed (then the
    numbers rise with gaps)."""
    return places.ordinals(df, [F.col(c) for c in order]) if order else df.withColumn("_ord", F.monotonically_increasing_id())


def lexicon(path: str) -> tuple[tuple[str, str], ...]:
    return tuple(json.loads(Path(path).read_text(encoding="utf-8")).items())
