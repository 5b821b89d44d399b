"""Model runs that go on where they stopped, and keep every key's quotas over the whole cluster."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import places
from ..operators.schedule import DAY, Quota, schedule
from ..operators.summarize import ATTEMPTS, retried
from ..sources import tables

#: Calls of a wave, whose answers are committed together: of the first one, and of any where no size is given.
WAVE, MOST = 50, 3200
#: Seconds: after a wave that took less, the next one has twice as many calls.
SHORT = 20.0
SCHEMA = "call_id string, response string, key_no int, asked_at double"

Client = Callable[[str], str]


def call_id(prompt: Column) -> Column:
    """What identifies a call: its prompt.  A changed prompt is another call."""
    return F.sha2(prompt, 256)


@dataclass(frozen=True)
class Pace:
    """When calls may be made: how many keys, the quota of each, seconds of a minute (tests use shorter ones),
    seconds at either end of it in which no call starts, as clocks of workers differ, and seconds that a
    plan needs before its first call."""

    keys: int
    quota: Quota
    minute: float = 60.0
    guard: float = 1.0
    lead: float = 10.0


class Ledger:
    """Answers of model calls in a folder.  Each wave of calls is one folder, written aside and renamed when it
    is whole; a run that is killed loses the wave it was at, and no other."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def waves(self) -> list[str]:
        return [n for n in tables.names(self.spark, self.root) if n.startswith("wave-")]

    def rows(self) -> DataFrame:
        """All committed rows, calls that failed included."""
        paths = [f"{self.root}/{n}" for n in self.waves()]
        return self.spark.read.schema(SCHEMA).parquet(*paths) if paths else self.spark.createDataFrame([], SCHEMA)

    def finished(self) -> DataFrame:
        """call_id, response of answered calls; of several answers to a call the first."""
        rows = self.rows().where("response is not null")
        return rows.groupBy("call_id").agg(F.min_by("response", F.struct("asked_at", "response")).alias("response"))

    def pending(self, calls: DataFrame) -> DataFrame:
        """call_id, prompt of the distinct calls without an answer; null prompts are no calls."""
        asked = calls.where(F.col("prompt").isNotNull()).select(call_id(F.col("prompt")).alias("call_id"), "prompt").dropDuplicates(["call_id"])
        return asked.join(self.finished().select("call_id"), "call_id", "left_anti")

    def commit(self, answers: DataFrame) -> None:
        """Writes the answers of a wave, calling the model on the way, and makes them count in one step."""
        aside = f"{self.root}/_open-{uuid.uuid4().hex}"
        answers.write.parquet(aside)
        if not tables.move(self.spark, aside, f"{self.root}/wave-{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"):
            raise OSError(f"{aside} can't be renamed")

    def spent(self, since: float) -> int:
        """Calls of the busiest key since a time, failed ones included."""
        most = self.rows().where(F.col("asked_at") >= since).groupBy("key_no").count().agg(F.max("count")).first()[0]
        return most or 0

    def run(self, calls: DataFrame, make: Callable[[], Client], wave: int | None = None, attempts: int = ATTEMPTS, wait: float = 0.0, clients: int | None = None) -> DataFrame:
        """calls (with a column prompt) with response; null where every attempt failed.

        Calls that the ledger has answered aren't made again, equal prompts are asked once, and each wave
        of so many calls (see run_waves()) is committed before the next begins; clients bounds how many workers ask at once.
        Failed calls are tried again by the next run.  A task that Spark repeats asks its calls again."""
        at_once = clients or min(wave or WAVE, self.spark.sparkContext.defaultParallelism)
        self.run_waves(calls, lambda own: own.repartition(at_once, "call_id").mapInPandas(_asking(make, attempts, wait), SCHEMA), wave)
        return self.answers(calls)

    def run_waves(self, calls: DataFrame, ask: Callable[[DataFrame], DataFrame], wave: int | None = None) -> None:
        """Commits ask(call_id, prompt) of pending calls, so many at a time.  Without a size waves begin with WAVE
        calls and double (to MOST) while they take less than SHORT seconds: quick calls need few commits, and
        of slow ones a run that is killed still loses little work."""
        todo = tables.staged(places.ordinals(self.pending(calls), [F.col("call_id")], "place"), "calls")
        total, begin, size = todo.count(), 0, wave or WAVE
        while begin < total:
            since = time.monotonic()
            self.commit(ask(todo.where((F.col("place") >= begin) & (F.col("place") < begin + size)).drop("place")))
            begin += size
            if wave is None and time.monotonic() - since < SHORT:
                size = min(2 * size, MOST)

    def run_paced(self, calls: DataFrame, make: Callable[[int], Client], pace: Pace, tokens: Column | None = None, slots: int = 5, passes: int = 100) -> DataFrame:
        """The same with keys: make(key number) builds a client, and every call waits for the slot that
        schedule() gives it.  Slots are wall-clock minutes, so a key never has more calls or tokens in one, or
        calls in a day, than its quota, whatever workers there are.  One attempt a call, as attempts count
        too; a call whose slot has gone by when a worker comes to it isn't made.  Waves of so many slots are committed
        as they end; what failed or came too late is scheduled anew, in so many passes at most or until all
        calls of a pass fail, and is null after that.  tokens is an expression over prompt."""
        for _ in range(passes):
            todo = self.pending(calls)
            now = time.time() + pace.lead
            day = now - now % (DAY * pace.minute)
            minute = int((now - day) // pace.minute) + 1
            if minute == DAY:
                day, minute = day + DAY * pace.minute, 0
            planned = tables.staged(schedule(todo, pace.keys, pace.quota, [F.col("call_id")], tokens, minute, self.spent(day)), "schedule")
            asked, said, begin = self.rows().count(), self.finished().count(), planned.agg(F.min("slot")).first()[0]
            if begin is None:
                break
            while begin is not None:
                own = planned.where((F.col("slot") >= begin) & (F.col("slot") < begin + slots))
                self.commit(own.repartitionByRange("slot", "key_no").sortWithinPartitions("slot", "in_slot").mapInPandas(_pacing(make, pace, day), SCHEMA))
                begin = planned.where(F.col("slot") >= begin + slots).agg(F.min("slot")).first()[0]
            if self.rows().count() > asked and self.finished().count() == said:
                break  # the model answers no more
        return self.answers(calls)

    def answers(self, calls: DataFrame) -> DataFrame:
        """calls with the ledger's response; null where there is none."""
        said = self.finished().withColumnRenamed("call_id", "_call")
        return calls.drop("response").withColumn("_id", call_id(F.col("prompt"))).join(said, F.col("_id") == F.col("_call"), "left").drop("_id", "_call")


def _asking(make: Callable[[], Client], attempts: int, wait: float):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client = make()
        for frame in frames:
            for i, prompt in zip(frame["call_id"], frame["prompt"], strict=True):
                said = retried(lambda: client(prompt), attempts, wait)  # noqa: B023
                yield pd.DataFrame({"call_id": [i], "response": pd.Series([said], dtype=object), "key_no": pd.Series([None], dtype="Int32"), "asked_at": [time.time()]})

    return run


def _pacing(make: Callable[[int], Client], pace: Pace, day: float):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        clients: dict[int, Client] = {}
        for frame in frames:
            for i, prompt, key, slot in zip(frame["call_id"], frame["prompt"], frame["key_no"], frame["slot"], strict=True):
                due = day + slot * pace.minute
                time.sleep(max(0.0, due + pace.guard - time.time()))
                if (now := time.time()) > due + pace.minute - pace.guard:
                    continue  # its slot is over
                client = clients.get(key) or clients.setdefault(key, make(int(key)))
                said = retried(lambda: client(prompt), 1)  # noqa: B023
                yield pd.DataFrame({"call_id": [i], "response": pd.Series([said], dtype=object), "key_no": pd.Series([key], dtype="Int32"), "asked_at": [now]})

    return run
