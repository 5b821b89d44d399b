"""Places and running sums over whole tables and over groups of any size, without a task that holds them.

Rows are range-sorted and written once, so that every later step sees the same blocks.  A block's rows are
numbered inside it; only the blocks' sizes (or sums) are added up across blocks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources import tables

_PART, _AT, _G, _BEFORE, _FIRST, _OWN = (f"__places_{x}" for x in ("part", "at", "g", "before", "first", "own"))


def _blocks(df: DataFrame, order: list[Column]) -> DataFrame:
    """df range-sorted, with the number of each row's block and the row's place inside it."""
    rows = df.repartitionByRange(*order).sortWithinPartitions(*order)
    at = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return tables.staged(rows.withColumns({_PART: F.spark_partition_id(), _AT: at}), "blocks")


def _joined(rows: DataFrame, pieces: DataFrame, groups: list[str]) -> DataFrame:
    on = rows[_PART] == pieces[f"{_PART}2"]
    for k, g in enumerate(groups):
        on &= rows[g].eqNullSafe(pieces[f"{_G}{k}"])
    return rows.join(pieces, on)


def running(df: DataFrame, order: list[Column], group: str | list[str] | None = None, value: Column | None = None, name: str = "running") -> DataFrame:
    """Adds the sum of value (of ones, if not given) over the rows before each row, in its group if given.

    A group is cut where blocks end.  Pieces of groups have one row each in the second step, so a group
    has as many as there are blocks at most, and rows meet their own piece by block and group: a group
    that holds a third of all rows spreads over a third of the blocks.  Null is a group; null values count
    as 0; rows equal in order come in any, but one, order."""
    groups = [group] if isinstance(group, str) else list(group or [])
    rows = _blocks(df if value is None else df.withColumn(_OWN, F.coalesce(value, F.lit(0))), [F.col(g) for g in groups] + order)
    kind = "long" if value is None else rows.schema[_OWN].dataType.simpleString()
    kind = kind if kind in ("double", "float") else "long"
    size = F.count("*") if value is None else F.sum(_OWN).cast(kind)
    pieces = rows.groupBy(F.col(_PART).alias(f"{_PART}2"), *(F.col(g).alias(f"{_G}{k}") for k, g in enumerate(groups))).agg(size.alias(_OWN + "2"), F.min(_AT).alias(_FIRST))
    if groups:
        earlier = Window.partitionBy(*(f"{_G}{k}" for k in range(len(groups)))).orderBy(f"{_PART}2").rowsBetween(Window.unboundedPreceding, -1)
        pieces = pieces.withColumn(_BEFORE, F.coalesce(F.sum(_OWN + "2").over(earlier), F.lit(0)).cast(kind))
    else:  # one row a block: their sums meet on the driver
        total, starts = 0, []
        for part, own, first in sorted(tuple(r) for r in pieces.collect()):
            starts.append((part, first, total))
            total += own
        pieces = F.broadcast(df.sparkSession.createDataFrame(starts, f"{_PART}2 int, {_FIRST} long, {_BEFORE} {kind}"))
    if value is None:
        inside = F.col(_AT) - F.col(_FIRST)
    else:
        inside = F.col(_OWN + "3")
        earlier = Window.partitionBy(_PART, *groups).orderBy(_AT).rowsBetween(Window.unboundedPreceding, -1)
        rows = rows.withColumn(_OWN + "3", F.coalesce(F.sum(_OWN).over(earlier), F.lit(0)).cast(kind))
    out = _joined(rows, pieces, groups).withColumn(name, F.col(_BEFORE) + inside)
    return out.select(*(c for c in df.columns if c != name), name)


def sequences(df: DataFrame, order: list[Column], groups: dict[str, list[str]]) -> DataFrame:
    """Adds 1, 2, ... inside each group under each name, with one sort for all.  order must keep the rows of
    every group together, as (key, time) does for a key's minutes and days."""
    rows, own = _blocks(df, order), [c for c in df.columns if c not in groups]
    for name, of in groups.items():
        pieces = rows.groupBy(F.col(_PART).alias(f"{_PART}2"), *(F.col(g).alias(f"{_G}{k}") for k, g in enumerate(of))).agg(F.count("*").alias(_OWN), F.min(_AT).alias(_FIRST))
        earlier = Window.partitionBy(*(f"{_G}{k}" for k in range(len(of)))).orderBy(f"{_PART}2").rowsBetween(Window.unboundedPreceding, -1)
        pieces = pieces.withColumn(_BEFORE, F.coalesce(F.sum(_OWN).over(earlier), F.lit(0)))
        place = F.col(_BEFORE) + F.col(_AT) - F.col(_FIRST) + 1
        own.append(name)
        rows = _joined(rows, pieces, of).withColumn(name, place).select(*own, _PART, _AT)
    return rows.select(*own)


def previous(df: DataFrame, order: list[Column], group: str, value: Column, name: str = "previous") -> DataFrame:
    """Adds the value of the row before each row in its group; null for the first.  Where a block begins
    inside a group, the value comes from the group's last row in the block before."""
    rows = _blocks(df.withColumn(_OWN, value), [F.col(group), *order])
    inside = Window.partitionBy(_PART, group).orderBy(_AT)
    rows = rows.withColumns({name: F.lag(_OWN).over(inside), _FIRST: F.min(_AT).over(Window.partitionBy(_PART, group))})
    pieces = rows.groupBy(F.col(_PART).alias(f"{_PART}2"), F.col(group).alias(f"{_G}0")).agg(F.max_by(_OWN, _AT).alias(_OWN + "2"))
    pieces = pieces.withColumn(_BEFORE, F.lag(_OWN + "2").over(Window.partitionBy(f"{_G}0").orderBy(f"{_PART}2")))
    out = _joined(rows, pieces, [group]).withColumn(name, F.when(F.col(_AT) == F.col(_FIRST), F.col(_BEFORE)).otherwise(F.col(name)))
    return out.select(*(c for c in df.columns if c != name), name)


def ordinals(df: DataFrame, order: list[Column], name: str = "_ord") -> DataFrame:
    """Adds each row's place in the order over the whole table, from 0."""
    return running(df, order, name=name)


def sequence(df: DataFrame, group: str, order: list[Column], name: str = "seq") -> DataFrame:
    """1, 2, ... inside each group, whatever its size."""
    return running(df, order, group, name=name).withColumn(name, F.col(name) + 1)


def chunks(df: DataFrame, order: list[Column], size: int, group: str | None = None, name: str = "batch") -> DataFrame:
    """Batches of `size` rows numbered from 0, inside each group if given, else over the whole table."""
    return running(df, order, group, name=name).withColumn(name, F.floor(F.col(name) / size))
