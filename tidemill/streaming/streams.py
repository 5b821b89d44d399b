"""Incremental forms of the batch operators, for Structured Streaming."""

from __future__ import annotations

import threading
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StatefulProcessor, StatefulProcessorHandle, StreamingQueryListener
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def dedup(stream: DataFrame, keys: tuple[str, ...] = ("author", "comment_raw", "created_date"), ts: str = "ts", delay: str = "1 hour") -> DataFrame:
    """Each comment once while the watermark lasts."""
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))


def label_counts(stream: DataFrame, label: str = "label") -> DataFrame:
    """Running counts of each label, for update or complete mode."""
    return stream.groupBy(label).agg(F.count("*").alias("n"))


def minute_counts(stream: DataFrame, key: str, ts: str = "ts", delay: str = "5 minutes") -> DataFrame:
    """Requests of each key and minute, closed by the watermark."""
    return stream.withWatermark(ts, delay).groupBy(key, F.window(ts, "1 minute").alias("minute")).agg(F.count("*").alias("n"))


def quota(stream: DataFrame, per_minute: int, key: str = "key", ts: str = "ts", id_col: str = "id", gap_s: int = 60) -> DataFrame:
    """Requests with in_burst and admitted, answered at once; a key's count starts anew after gap_s seconds
    without one.  Requests of a micro-batch are taken in order of time; between batches they count as they
    come, and a key's two numbers stay.  ordered_quota() puts requests in order and forgets silent keys."""

    def step(own: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last, n = state.get if state.exists else (None, 0)
        rows = []
        for t, i in sorted((t, i) for f in frames for t, i in zip(f[ts], f[id_col], strict=True)):
            now = t.timestamp()
            n = 1 if last is None or now - last >= gap_s else n + 1
            last = now
            rows.append((own[0], i, n, n <= per_minute))
        state.update((last, n))
        yield pd.DataFrame(rows, columns=["key", "id", "in_burst", "admitted"])

    kinds = {c: stream.schema[c].dataType.simpleString() for c in (key, id_col)}
    return stream.groupBy(key).applyInPandasWithState(step, f"key {kinds[key]}, id {kinds[id_col]}, in_burst long, admitted boolean", "last double, n long", "append", GroupStateTimeout.NoTimeout)


class _Bursts(StatefulProcessor):
    """Requests of a key wait until the watermark has passed them and are then counted in order of time; a key
    whose last request lies gap_s seconds behind the watermark is forgotten."""

    def __init__(self, per_minute: int, gap_s: int, id_type: str):
        self.per_minute, self.gap, self.id_type = per_minute, gap_s * 1_000_000, id_type

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", f"us long, id {self.id_type}")
        self.burst = handle.getValueState("burst", "last long, n long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        new = [(int(us), i) for frame in rows for us, i in zip(frame["us"], frame["id"].tolist(), strict=True)]
        self.waiting.appendList(new)
        for us in {us for us, _ in new}:
            self.handle.registerTimer(us // 1000)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        until = (expiredTimerInfo.getExpiryTimeInMs() + 1) * 1000
        held = sorted((us, i) for us, i in self.waiting.get())
        due, later = [x for x in held if x[0] < until], [x for x in held if x[0] >= until]
        last, n = self.burst.get() if self.burst.exists() else (None, 0)
        out = []
        for us, i in due:
            n = 1 if last is None or us - last >= self.gap else n + 1
            last = us
            out.append((key[0], i, n, n <= self.per_minute))
        if due:
            self.waiting.put(later) if later else self.waiting.clear()
            self.burst.update((last, n))
            self.handle.registerTimer((last + self.gap) // 1000)
            yield pd.DataFrame(out, columns=["key", "id", "in_burst", "admitted"])
        elif last is not None and last + self.gap < until:
            self.burst.clear()

    def close(self) -> None:
        pass


def ordered_quota(stream: DataFrame, per_minute: int, key: str = "key", ts: str = "ts", id_col: str = "id", gap_s: int = 60, delay: str = "1 minute") -> DataFrame:
    """key, id, in_burst and admitted of requests, as the batch query has them; a key's count starts anew
    after gap_s seconds without a request.

    Requests that come out of order within the delay are put in order (equal times by id) before they are
    counted, so a request is answered once the watermark has passed it; later ones are dropped by the
    watermark.  State of a key that has been silent for gap_s seconds goes by a timer.  Needs the RocksDB state
    store.  Null keys are a key, null times are dropped."""
    kinds = {c: stream.schema[c].dataType.simpleString() for c in (key, id_col)}
    rows = stream.where(F.col(ts).isNotNull()).select(F.col(key).alias("key"), F.col(id_col).alias("id"), F.col(ts).cast("timestamp").alias("_ts")).withWatermark("_ts", delay)
    rows = rows.withColumn("us", F.unix_micros("_ts"))
    return rows.groupBy("key").transformWithStateInPandas(_Bursts(per_minute, gap_s, kinds[id_col]), f"key {kinds[key]}, id {kinds[id_col]}, in_burst long, admitted boolean", "Append", "EventTime")


class _Quiet(StreamingQueryListener):
    """Sets done once a query had so many triggers in a row without new rows, or its rows reach a cap."""

    def __init__(self, triggers: int, most: int | None):
        self.triggers, self.most = triggers, most
        self.quiet = self.rows = 0
        self.query: str | None = None
        self.done = threading.Event()

    def _see(self, run: str, rows: int) -> None:
        if run != self.query:
            return
        self.rows += rows
        self.quiet = 0 if rows else self.quiet + 1
        if self.quiet >= self.triggers or self.most is not None and self.rows >= self.most:
            self.done.set()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self._see(str(event.progress.runId), event.progress.numInputRows)

    def onQueryIdle(self, event) -> None:
        self._see(str(event.runId), 0)

    def onQueryTerminated(self, event) -> None:
        if str(event.runId) == self.query:
            self.done.set()


def until_quiet(writer: DataStreamWriter, spark: SparkSession, triggers: int = 3, interval: str = "1 second", most: int | None = None, timeout: float | None = None) -> int:
    """Starts a stream and stops it after so many triggers in a row without new rows, once it has taken
    `most` rows (a cap that the last trigger may pass), or after a timeout in seconds.  Returns the rows
    taken; started again with its checkpoint, the stream goes on there.  An error of the query is raised."""
    name = "spark.sql.streaming.noDataProgressEventInterval"
    held = spark.conf.get(name, None)
    spark.conf.set(name, "0")  # an event for every trigger, also without rows
    watch = _Quiet(triggers, most)
    spark.streams.addListener(watch)
    try:
        query = writer.trigger(processingTime=interval).start()
        watch.query = str(query.runId)
        watch.done.wait(timeout)
        query.stop()
        if (failed := query.exception()) is not None:
            raise failed
    finally:
        spark.streams.removeListener(watch)
        spark.conf.set(name, held) if held is not None else spark.conf.unset(name)
    return watch.rows


def drain(stream: DataFrame, path: str, checkpoint: str):
    """Writes all that is there now and stops; started again, it goes on from its checkpoint."""
    return stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
