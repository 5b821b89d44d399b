"""A schedule of model calls that keeps every key's quotas on any number of workers."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import rules
from . import places

#: Minutes of a day.
DAY = 1440


@dataclass(frozen=True)
class Quota:
    """Requests a minute, tokens a minute and requests a day of one key."""

    per_minute: int
    tokens: int
    per_day: int

    def __post_init__(self):
        if min(self.per_minute, self.tokens, self.per_day) < 1:
            raise ValueError("quotas are 1 at least")

    @classmethod
    def of(cls, model: str, share: float = 1.0) -> Quota:
        """The quota table's row of a model (the default model's, if it has none), or a share of it."""
        table = {m: (rpm, tpm, rpd) for m, rpm, rpd, tpm in rules.QUOTAS}
        return cls(*(max(1, int(x * share)) for x in table.get(model, table[rules.DEFAULT_MODEL])))


def fill_minutes(tokens: np.ndarray, quota: Quota) -> np.ndarray:
    """The minute of each call of one key's day, in order: a call goes to the minute of the one before
    unless that would have too many calls or tokens.  A call over the tokens of a minute has one alone."""
    out = np.empty(len(tokens), np.int64)
    minute, calls, held = 0, 0, 0
    for i, n in enumerate(tokens.tolist()):
        if calls and (calls == quota.per_minute or held + n > quota.tokens):
            minute, calls, held = minute + 1, 0, 0
        out[i], calls, held = minute, calls + 1, held + n
    return out


def schedule(calls: DataFrame, keys: int, quota: Quota, order: list[Column], tokens: Column | None = None, start_minute: int = 0, spent: int = 0) -> DataFrame:
    """calls with key_no (0 to keys - 1), slot (the minute in which the call may start, from midnight of the
    first day), in_slot (its place among the key's calls of that minute, from 0) and over_tokens.

    No key has more calls or tokens in a slot, or calls in a day, than the quota says; a call that alone is
    over the tokens of a minute has a slot alone and over_tokens true.  Slots of different keys and minutes
    are disjoint sets of calls, so whichever worker makes them, the quotas hold.

    Calls are numbered over the whole table and dealt to keys in turn.  A key's calls are cut into days of
    quota.per_day calls, which are filled minute by minute, each day by itself, in one task (per_day calls
    at most); days that tokens make longer than a day push later ones back.  The first day begins at
    start_minute, with `spent` of each key's calls made already.  tokens is 1 where not given; nulls and
    numbers under 0 count as 0.  An empty table has an empty schedule."""
    if keys < 1 or not 0 <= start_minute < DAY or spent < 0:
        raise ValueError("keys is 1 at least, start_minute a minute of the day, spent not under 0")
    own = F.greatest(F.lit(0), F.coalesce(tokens.cast("long"), F.lit(0))) if tokens is not None else F.lit(1)
    rows = places.ordinals(calls.withColumn("__tokens", own.cast("long")), order, "__i")
    first = max(0, quota.per_day - spent)
    j = F.floor(F.col("__i") / keys)
    day = F.when(j < first, F.lit(0)).otherwise(F.floor((j - first) / quota.per_day) + 1).cast("long")
    rows = rows.withColumns({"key_no": (F.col("__i") % keys).cast("int"), "__day": day})

    def fill(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("__i")
        minute = fill_minutes(frame["__tokens"].to_numpy(), quota)
        place = np.arange(len(minute)) - np.searchsorted(minute, minute)
        return pd.DataFrame({"__i": frame["__i"], "_key": frame["key_no"], "_d": frame["__day"], "_minute": minute, "in_slot": place, "over_tokens": frame["__tokens"] > quota.tokens})

    filled = rows.select("__i", "key_no", "__day", "__tokens").groupBy("key_no", "__day").applyInPandas(fill, "__i long, _key int, _d long, _minute long, in_slot long, over_tokens boolean")
    filled = places.tables.staged(filled, "minutes")
    begins = F.when(F.col("_d") == 0, F.lit(start_minute)).otherwise(F.lit(0))
    days = filled.groupBy("_key", "_d").agg((F.max("_minute") + 1).alias("_used"))
    days = places.running(days.withColumn("_len", F.ceil((F.col("_used") + begins) / DAY)), [F.col("_d")], "_key", F.col("_len"), "_from")
    from_day = F.col("_from") + (F.lit(1) if not first else F.lit(0))  # with nothing left of today, the first calls are tomorrow's
    slots = days.select(F.col("_key").alias("_key2"), F.col("_d").alias("_d2"), (from_day * DAY + begins).alias("_first"))
    placed = filled.join(slots, (F.col("_key") == F.col("_key2")) & (F.col("_d") == F.col("_d2"))).select(F.col("__i").alias("__i2"), (F.col("_first") + F.col("_minute")).alias("slot"), "in_slot", "over_tokens")
    kept = [c for c in calls.columns if c not in ("key_no", "slot", "in_slot", "over_tokens")]
    return rows.select(*kept, "key_no", "__i").join(placed, F.col("__i") == F.col("__i2")).select(*kept, "key_no", "slot", "in_slot", "over_tokens")


def usage(scheduled: DataFrame, tokens: Column | None = None) -> DataFrame:
    """key_no, slot, calls and tokens of every slot: what a key's quotas are held against."""
    return scheduled.groupBy("key_no", "slot").agg(F.count("*").alias("calls"), F.sum(tokens if tokens is not None else F.lit(1)).alias("tokens"))
