"""Stages over many files with a result for each, where a broken file fails alone."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..sources import readers, tables

#: Files of one job; each has a counter of its own in it.
AT_ONCE = 64
REPORT = "file string, rows_in long, kept long, removed long, error string"


def run_files(spark: SparkSession, paths: Sequence[str], step: Callable[[DataFrame], tuple[DataFrame, DataFrame]], out: str, read: Callable[[list[str]], DataFrame] | None = None, at_once: int = AT_ONCE) -> DataFrame:
    """Runs step (rows to kept and removed ones) over files and returns one row a file: rows_in, kept,
    removed, error (null where all went well).

    read takes paths and gives rows with file_name; step keeps that column.  Files go in jobs of so many;
    a job that fails is halved until the broken files stand alone, so n good files cost n / at_once jobs and a
    broken one about 2 log2(at_once) more.  What a job keeps and removes appears under out/kept and
    out/removed in one step once both are written; a broken file leaves nothing there.  Rows are counted on
    their way (observe), not by a further scan.  Files need names of their own."""
    read = read or (lambda own: readers.read_scraped(spark, own, fail=True))
    name = {p: p.rstrip("/").rsplit("/", 1)[-1] for p in paths}
    if len(set(name.values())) < len(name):
        raise ValueError("two files have the same name")
    report: list[tuple] = []

    def attempt(own: list[str]) -> None:
        aside = f"{out.rstrip('/')}/_open-{uuid.uuid4().hex}"
        try:
            seen = Observation()
            rows = read(own)
            rows = rows.observe(seen, *(F.count_if(F.col("file_name") == name[p]).alias(f"n{k}") for k, p in enumerate(own)))
            kept, _ = step(rows)
            kept.write.parquet(f"{aside}/kept")
            _, removed = step(read(own))
            removed.write.parquet(f"{aside}/removed")
            counts = {}
            for kind in ("kept", "removed"):
                written = spark.read.schema("file_name string").parquet(f"{aside}/{kind}")
                counts[kind] = dict(written.groupBy("file_name").count().collect())  # one row a file
        except Exception as e:
            tables.remove(spark, aside)
            if len(own) == 1:
                report.append((name[own[0]], None, 0, 0, str(e).split("\n")[0][:500]))
                return
            half = len(own) // 2
            attempt(own[:half])
            attempt(own[half:])
            return
        for kind in ("kept", "removed"):
            tables.move(spark, f"{aside}/{kind}", f"{out.rstrip('/')}/{kind}/part-{uuid.uuid4().hex}")
        tables.remove(spark, aside)
        got = seen.get
        report.extend((name[p], got[f"n{k}"], counts["kept"].get(name[p], 0), counts["removed"].get(name[p], 0), None) for k, p in enumerate(own))

    for k in range(0, len(paths), at_once):
        attempt(list(paths[k : k + at_once]))
    return spark.createDataFrame(report, REPORT)
