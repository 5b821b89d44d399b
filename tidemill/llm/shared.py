"""Lineage cuts in the shared folder, ranks over whole tables, and small text expressions."""

from __future__ import annotations

import atexit
import gc
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The six characters that separate words everywhere in this subpackage.
SPACE = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"

#: Bits that sieve() broadcasts at most: 32 MB.
SIEVE = 1 << 28

_local: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir; a temporary one only where it is
    unset and the session is local, as in tests."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        if "dir" not in _local:
            _local["dir"] = tempfile.mkdtemp(prefix="tidemill-")
            atexit.register(shutil.rmtree, _local["dir"], ignore_errors=True)
        base = f"file://{_local['dir']}"
    return f"{base.rstrip('/')}/tidemill-{spark.sparkContext.applicationId}"


def discard(spark: SparkSession, path: str) -> None:
    """Deletes a folder that later plans no longer read."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def stage(df: DataFrame, name: str, tidy: bool = False) -> DataFrame:
    """Writes df as a table in the shared folder and reads it back: later plans start from files that
    outlive any executor.  release() deletes the session's tables.

    tidy is for large steps: Spark deletes shuffle files once the driver has collected the plan that made
    them, which a driver with free memory may put off for long; so it is asked to collect now."""
    spark, schema = df.sparkSession, df.schema
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    if tidy:
        del df
        gc.collect()
        spark.sparkContext._jvm.System.gc()
    return spark.read.schema(schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Deletes every table that stage() wrote in this session."""
    discard(spark, shared_dir(spark))


def sieve(rows: DataFrame, wanted: DataFrame, key: str, most: int = SIEVE) -> DataFrame:
    """rows without most of those whose key is not in wanted (a staged table), so that a join with wanted
    need not shuffle them.  Bits of hashed keys are broadcast, 16 to 32 a wanted row and most in all (32
    MB); no wanted row is lost, a few others stay.  Where wanted has more rows than most, rows stay as
    they are: the filter would pass nearly all.  Null keys go."""
    n = wanted.count()
    if n > most:
        return rows
    bits = min(most, 1 << max(15, (16 * n).bit_length()))
    place = F.pmod(F.xxhash64(key), F.lit(bits))
    asked = wanted.select(F.floor(place / 32768).alias("_map"), (place % 32768).alias("_bit")).repartition("_map")
    maps = asked.groupBy("_map").agg(F.bitmap_construct_agg("_bit").alias("_bits"))
    at = place % 32768
    byte = F.conv(F.hex(F.substring("_bits", (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    weight = F.element_at(F.array(*(F.lit(1 << i) for i in range(8))), (at % 8 + 1).cast("int"))
    found = rows.withColumn("_map", F.floor(place / 32768)).join(F.broadcast(maps), "_map").where(byte.bitwiseAND(weight) != 0)
    return found.where(F.col(key).isNotNull()).select(*rows.columns)


def ranked(df: DataFrame, order: list[Column], name: str, rank: str = "rank") -> DataFrame:
    """Adds the 0-based place of each row in the order over the whole table, without gathering rows:
    a range sort numbers the rows of each partition, and only the partitions' sizes reach the driver."""
    own = F.monotonically_increasing_id()
    rows = stage(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_own", own), name)
    part = F.shiftright("_own", 33)
    sizes = sorted((r["part"], r["n"]) for r in rows.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect())
    before, starts = 0, []
    for p, n in sizes:
        starts += [F.lit(p), F.lit(before)]
        before += n
    place = F.col("_own").bitwiseAND(F.lit((1 << 33) - 1))
    return rows.withColumn(rank, (F.create_map(*starts)[part] + place) if starts else place).drop("_own")


def word_count(text: Column) -> Column:
    """Words of a text, null as none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def without_space(text: Column) -> Column:
    """The text without the six space characters, null as empty.  Byte searches, not a regex."""
    out = F.coalesce(text, F.lit(""))
    for c in SPACE:
        out = F.replace(out, F.lit(c), F.lit(""))
    return out


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case; all other characters as they are."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def smallest_hashes(df: DataFrame, n: int, key: str) -> DataFrame:
    """The n rows with the smallest hashes of a column, all where there are fewer: the bounded sample
    that a fit sees.  A cut set from the row count keeps what is sorted near n rows at any size."""
    total = df.count()
    rows = df.withColumn("_hash", F.xxhash64(key))
    if total > 2 * n:
        rows = rows.where(F.col("_hash") < int(-(2**63) + 2**64 * (1.5 * n / total)))
    return rows.orderBy("_hash", key).limit(n).drop("_hash")
