"""Tables in a shared folder: steps written once, and snapshots published as a whole."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_local: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir; a temporary one only where it is unset
    and the session is local."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        if "dir" not in _local:
            _local["dir"] = tempfile.mkdtemp(prefix="tidemill-steps-")
            atexit.register(shutil.rmtree, _local["dir"], ignore_errors=True)
        base = f"file://{_local['dir']}"
    return f"{base.rstrip('/')}/steps-{spark.sparkContext.applicationId}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """df written to the shared folder and read back: what follows starts from files that outlive any
    executor, and sees the same rows each time."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _at(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def names(spark: SparkSession, path: str) -> list[str]:
    """What a folder holds, in order; nothing for a folder that isn't there."""
    fs, at = _at(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(at)) if fs.exists(at) else []


def move(spark: SparkSession, source: str, target: str) -> bool:
    """Renames a folder in one step; false where the target is there already."""
    fs, at = _at(spark, target)
    fs.mkdirs(at.getParent())
    return not fs.exists(at) and bool(fs.rename(_at(spark, source)[1], at))


def remove(spark: SparkSession, path: str) -> None:
    fs, at = _at(spark, path)
    fs.delete(at, True)


def _versions(spark: SparkSession, root: str) -> list[int]:
    return [int(n.removeprefix("at-")) for n in names(spark, f"{root}/_versions") if n.startswith("at-")]


def version(spark: SparkSession, root: str) -> int:
    """The number of the current version; 0 before the first."""
    return max(_versions(spark, root), default=0)


def publish(df: DataFrame, root: str, seen: int | None = None) -> int:
    """Makes df the table's next version and returns its number.

    The rows go to a folder of their own first; then one small file named by the version's number is created, which
    fails where another writer has created it.  So readers see the old or the new version whole, a failed
    write leaves the old one readable, and df may read the version that it replaces.  seen is the version
    that df was made from (the one at the call, if not given): a writer that another one has overtaken gets
    an error, and its rows are deleted."""
    spark, root = df.sparkSession, root.rstrip("/")
    seen = version(spark, root) if seen is None else seen
    folder = f"rows-{uuid.uuid4().hex}"
    df.write.parquet(f"{root}/{folder}")
    fs, at = _at(spark, f"{root}/_versions/at-{seen + 1:08d}")
    try:
        if version(spark, root) != seen:
            raise FileExistsError(f"version {seen + 1} is there already")
        fs.mkdirs(at.getParent())
        out = fs.create(at, False)  # not over a file that is there
        out.write(bytearray(folder.encode()))
        out.close()
    except Exception as e:
        remove(spark, f"{root}/{folder}")
        raise FileExistsError(f"another writer made version {seen + 1} of {root}") from e
    return seen + 1


def published(spark: SparkSession, root: str, number: int | None = None) -> DataFrame:
    """The current version of a table, or an earlier one by its number."""
    root = root.rstrip("/")
    number = version(spark, root) if number is None else number
    if not number:
        raise FileNotFoundError(f"{root} has no version")
    folder = spark.read.text(f"{root}/_versions/at-{number:08d}").first().value
    return spark.read.parquet(f"{root}/{folder}")


def forget(spark: SparkSession, root: str, keep: int = 2) -> None:
    """Deletes all but the newest versions, and rows that no version names.  Not while a writer works."""
    root = root.rstrip("/")
    held = sorted(_versions(spark, root))[-keep:]
    used = {spark.read.text(f"{root}/_versions/at-{n:08d}").first().value for n in held}
    for n in _versions(spark, root):
        if n not in held:
            remove(spark, f"{root}/_versions/at-{n:08d}")
    for name in names(spark, root):
        if name.startswith("rows-") and name not in used:
            remove(spark, f"{root}/{name}")


def write_sorted(df: DataFrame, path: str, key: str, rows_a_file: int = 1_000_000) -> str:
    """Writes df in files of about so many rows that follow each other by key, with the least and the greatest key of
    each file in path/_index.  Null keys are in the first file."""
    path, spark = path.rstrip("/"), df.sparkSession
    files = max(1, -(-df.count() // rows_a_file))
    df.repartitionByRange(files, key).sortWithinPartitions(key).write.parquet(f"{path}/rows")
    written = spark.read.parquet(f"{path}/rows").select(F.col("_metadata.file_name").alias("file"), F.col(key).alias("key"))
    written.groupBy("file").agg(F.min("key").alias("least"), F.max("key").alias("most")).write.parquet(f"{path}/_index")
    return path


def lookup(spark: SparkSession, path: str, key: str, values: list) -> DataFrame:
    """The rows of a table of write_sorted() with these keys, read from the files whose range of keys
    holds one; none for null."""
    path = path.rstrip("/")
    ranges, rows = spark.read.parquet(f"{path}/_index"), spark.read.parquet(f"{path}/rows")
    wanted = [v for v in values if v is not None]
    hits = F.lit(False)
    for v in wanted:
        hits = hits | F.lit(v).between(F.col("least"), F.col("most"))
    files = [r.file for r in ranges.where(hits).select("file").collect()]  # those of the keys asked for
    if not files:
        return rows.limit(0)
    return spark.read.schema(rows.schema).parquet(*(f"{path}/rows/{f}" for f in files)).where(F.col(key).isin(wanted))
