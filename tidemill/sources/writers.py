"""Writers and their overwrite rules."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import filters


def named(path: str, policy: str = "overwrite", model: str = "", now: datetime | None = None) -> str | None:
    """Where to write: 'overwrite', 'model' (model suffix), 'stamp' (model and time), 'cancel' (None)."""
    stem, dot, end = path.rpartition(".") if "." in path.rsplit("/", 1)[-1] else (path, "", "")
    tag = model.replace("-", "_").replace(".", "_")
    if policy == "cancel":
        return None
    if policy == "stamp":
        tag += "_" + (now or datetime.now()).strftime("%Y%m%d_%H%M%S")
    return path if policy == "overwrite" else f"{stem}_{tag.strip('_')}{dot}{end}"


def write_table(df: DataFrame, path: str, mode: str = "errorifexists") -> str:
    """Parquet, or CSV with a header where the path ends in .csv."""
    writer = df.write.mode(mode)
    writer.csv(path, header=True, escape='"') if path.rstrip("/").endswith(".csv") else writer.parquet(path)
    return path


def write_removed(df: DataFrame, path: str, mode: str = "errorifexists") -> str:
    df.write.mode(mode).partitionBy("removal_reason").parquet(path)
    return path


def write_long(df: DataFrame, root: str, max_words: int = 300, column: str = "comment_raw", now: datetime | None = None) -> str | None:
    """A backup of the rows that filter_long() removes, text, words and reason, in a folder named by the time; None
    where there is none."""
    _, gone = filters.filter_long(df, max_words, column)
    if gone.isEmpty():
        return None
    stamp = (now or datetime.now()).strftime("%Y%m%d_%H%M%S")
    return write_table(gone.select(column, "word_count_temp", "removal_reason"), f"{root.rstrip('/')}/long_comments_removed_{stamp}.parquet")


def write_lines(df: DataFrame, path: str, mode: str = "errorifexists") -> str:
    df.write.mode(mode).text(path)
    return path


def write_progress(df: DataFrame, root: str, seq: int) -> str:
    """A numbered snapshot; the newest whole one counts, and no input is overwritten.  tables.publish() numbers
    snapshots itself and swaps them in one step."""
    return write_table(df, f"{root.rstrip('/')}/snapshot-{seq:06d}.parquet", "overwrite")


def csv_line(*cells: Column) -> Column:
    """One CSV line, every cell quoted."""
    return F.concat_ws(",", *(F.concat(F.lit('"'), F.replace(F.coalesce(c.cast("string"), F.lit("")), F.lit('"'), F.lit('""')), F.lit('"')) for c in cells))


def write_excel(df: DataFrame, path: str) -> str:
    """A workbook, by the driver where a writer library is there; for small results only."""
    df.toPandas().to_excel(path, index=False)
    return path
