"""Removal of long repeated byte strings, by longest-previous-factor arrays over content-defined states.

A suffix matters here only by its first `length` bytes, so suffix order and factors are cut there.  The
positions of a text fall into states: runs of windows (a window is the first `length` bytes of a suffix) that
share their least k-gram hash.  Equal windows have equal least hashes, wherever they lie, so no factor leads
from one k-gram to another, and the suffix order can be made k-gram by k-gram: states equal as a whole are
settled by one hash each, and only states that share their k-gram but not their whole content send their
bytes to be sorted.  There the suffixes are put into order of their bytes, and the previous and the next
smaller position in that order give each its earlier factor.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import sieve, stage
from .words import U, chunks, mix, powers

LENGTH = 400
K = 64
#: States of one k-gram that one task sorts, at most; more are compared window by window in a shuffle.
GROUP = 8_192
#: States that are sorted together, about; those of one k-gram always are, up to GROUP.
TOGETHER = 512
SPANS = "array<struct<start:long,end:long>>"
_MAX = U(0xFFFFFFFFFFFFFFFF)


def _slide(x: np.ndarray, w: int, f: np.ufunc, pad: np.uint64) -> np.ndarray:
    """f over all windows of w values, in two running passes."""
    n = len(x)
    y = np.full(-(-n // w) * w, pad, U)
    y[:n] = x
    y = y.reshape(-1, w)
    left = f.accumulate(y[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return f(left[: n - w + 1], f.accumulate(y, axis=1).reshape(-1)[w - 1 : n])


class Hashes:
    """Hashes of any spans of a text in constant time each."""

    def __init__(self, text: bytes):
        buf = np.frombuffer(text, np.uint8)
        self.up, self.down = powers(len(buf) + 1)
        self.run = np.zeros(len(buf) + 1, U)
        np.cumsum((buf.astype(U) + U(1)) * self.up[: len(buf)], out=self.run[1:])

    def spans(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return mix((self.run[b] - self.run[a]) * self.down[a] + (b - a).astype(U))

    def windows(self, n: int) -> np.ndarray:
        """Hashes of all windows of n bytes."""
        return mix((self.run[n:] - self.run[:-n]) * self.down[: len(self.run) - n] + U(n))


def states(text: bytes, length: int = LENGTH, k: int = K) -> dict[str, np.ndarray] | None:
    """First and last window of each state, its key, its whole content's hash, hashes left and right of
    its k-gram (0 at a text's edge), and whether the k-gram occurs more than once in it."""
    n, w = len(text), length - k + 1
    if n < length:
        return None
    hashes = Hashes(text)
    h = hashes.windows(k)
    least = _slide(h, w, np.minimum, _MAX)
    cut = np.flatnonzero(least[1:] != least[:-1]) + 1
    first, last = np.concatenate([[0], cut]), np.concatenate([cut - 1, [len(least) - 1]])
    pieces = (last - first) // w + 1  # a long run is cut, so that its windows overlap
    own = np.repeat(np.arange(len(first)), pieces)
    nth = np.arange(len(own)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    first = first[own] + nth * w
    last = np.minimum(first + w - 1, last[own])
    key = least[first]
    wide = np.concatenate([np.zeros(w - 1, U), least, np.zeros(w - 1, U)])
    at = np.flatnonzero(_slide(wide, w, np.maximum, U(0)) == h)
    values, number = np.unique(h[at], return_inverse=True)
    order = np.sort(number * (n + 1) + at)
    base = np.searchsorted(values, key) * (n + 1)
    place = order[np.searchsorted(order, base + last)] - base
    many = np.searchsorted(order, base + last + w - 1, "right") - np.searchsorted(order, base + first) > 1
    half = (length - k) // 2
    zero, edge = np.zeros(len(first), U), (place >= half, place + k + half <= n)
    left, right = zero.copy(), zero.copy()
    left[edge[0]] = hashes.spans(place[edge[0]] - half, place[edge[0]] + k)
    right[edge[1]] = hashes.spans(place[edge[1]], place[edge[1]] + k + half)
    return {"first": first, "last": last, "key": key, "whole": hashes.spans(first, last + length), "left": left, "right": right, "many": many}


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def _state_rows(rows: DataFrame, length: int) -> DataFrame:
    """All states of each text: row, tag, first, last, key, whole, lhash, rhash, many."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for texts, part in chunks(batches, 2):
            for row, tag, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), texts, strict=True):
                s = states(text, length)
                if s is not None:
                    n = len(s["key"])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(n, row)), pa.array(np.full(n, tag)), pa.array(s["first"].astype(np.int32)), pa.array(s["last"].astype(np.int32)), *(_signed(s[c]) for c in ("key", "whole", "left", "right")), pa.array(s["many"])],
                        ["row", "tag", "first", "last", "key", "whole", "lhash", "rhash", "many"],
                    )

    return rows.mapInArrow(run, "row long, tag long, first int, last int, key long, whole long, lhash long, rhash long, many boolean")


def _likely(made: DataFrame) -> DataFrame:
    """Distinct states that occur again or share their k-gram with another place: key, whole, times, row, tag,
    first and last of one occurrence, lhash, rhash, n (distinct states of the k-gram), any_many."""
    one = F.min(F.struct("row", "tag", "first", "last"))
    distinct = made.groupBy("key", "whole").agg(F.count("*").alias("times"), one.alias("x"), F.first("lhash").alias("lhash"), F.first("rhash").alias("rhash"), F.first("many").alias("many")).select("*", "x.*").drop("x")
    by_key = distinct.groupBy("key").agg(F.count("*").alias("n"), F.max("many").alias("any_many")).where("n > 1 or any_many")
    return distinct.join(by_key, "key", "left").where("times > 1 or n is not null").drop("many")


def _wanted(likely: DataFrame) -> DataFrame:
    """States whose windows have to be compared: another state has the same k-gram and the same bytes on
    one side of it; every window holds one of the two sides whole."""
    rows = likely.where("n is not null")
    sides = [rows.where(f"{s} <> 0").groupBy("key", s).agg(F.count("*").alias(f"{s}_n")).where(f"{s}_n > 1") for s in ("lhash", "rhash")]
    rows = rows.join(sides[0], ["key", "lhash"], "left").join(sides[1], ["key", "rhash"], "left")
    return rows.where("any_many or lhash_n is not null or rhash_n is not null").select("key", "whole", "row", "tag", "first", "last", "n")


def _contexts(texts: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """key, whole, n, bytes of the wanted states, each cut out of one text that has it, and of its copies one."""
    asked = wanted.groupBy("row", "tag").agg(F.collect_list(F.struct("key", "whole", "n", "first", "last")).alias("asked"))
    raw = F.col("text").cast("binary")
    own = F.transform("asked", lambda x: F.struct(x["key"].alias("key"), x["whole"].alias("whole"), x["n"].alias("n"), F.substring(raw, x["first"] + 1, x["last"] - x["first"] + length).alias("bytes")))
    # rows of equal ids and texts give a state twice; its times are over 1 then, so its windows do not count
    return texts.join(asked, ["row", "tag"]).select(F.inline(own))


def _dense(x: np.ndarray) -> tuple[np.ndarray, int]:
    """The rank of each value among the distinct values, and how many those are."""
    order = np.argsort(x)
    x = x[order]
    number = np.concatenate([[0], np.cumsum(x[1:] != x[:-1])])
    rank = np.empty(len(x), U)
    rank[order] = number
    return rank, int(number[-1]) + 1


def suffix_order(buf: np.ndarray, at: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The suffixes of buf at the places `at` (ascending; `length` bytes follow each) in order of their first
    `length` bytes, equal ones in order of place, as numbers into `at`; and a rank per suffix, equal for
    equal bytes.  Ranks of short prefixes are packed, as many as 64 bits hold, into ranks of longer ones."""
    n, reach = len(buf), min(8, length)
    padded = np.concatenate([buf, np.zeros(length, np.uint8)])
    key = np.zeros(n, U)
    for k in range(reach):
        key = (key << U(8)) | padded[k : k + n]
    while reach < length:
        rank, many = _dense(key)
        bits = max(1, (many - 1).bit_length())
        parts = min(64 // bits, -(-length // reach))
        places = at if parts * reach >= length else np.arange(n)
        rank = np.concatenate([rank, np.zeros(length, U)])
        key = np.zeros(len(places), U)
        for k in range(parts):
            key = (key << U(bits)) | rank[places + min(k * reach, length - reach)]
        reach = min(parts * reach, length)
    key = key if len(key) == len(at) else key[at]
    order = np.argsort(key, kind="stable")
    rank = np.empty(len(at), np.int64)
    rank[order] = np.concatenate([[0], np.cumsum(key[order][1:] != key[order][:-1])]) if len(at) else 0
    return order, rank


def previous_smaller(x: np.ndarray) -> np.ndarray:
    """For each value of x (all different) the place of the nearest smaller one before it, -1 where there is
    none.  All values between a place and where it points are larger, so pointers may jump along each other."""
    to = np.arange(-1, len(x) - 1)
    todo = np.flatnonzero((to >= 0) & (x[to] > x))
    while len(todo):
        to[todo] = to[to[todo]]
        todo = todo[(to[todo] >= 0) & (x[to[todo]] > x[todo])]
    return to


def previous_factors(buf: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """For each suffix at the places `at`, the number of an earlier one that shares its first `length` bytes,
    -1 where there is none: the longest previous factor, cut at `length`.

    Of all earlier suffixes, one that shares most with a suffix is the nearest before or the nearest after it
    in suffix order: the previous or the next smaller position."""
    order, rank = suffix_order(buf, at, length)
    factor = np.full(len(at), -1)
    for seq in (order, order[::-1]):
        near = previous_smaller(seq)
        has = near >= 0
        one, other = seq[has], seq[near[has]]
        same = rank[one] == rank[other]
        factor[one[same]] = other[same]
    return factor


def _compare(contexts: DataFrame, length: int) -> DataFrame:
    """whole, a, b: first and last repeated window of a state, counted from its first."""

    def run(table: pa.Table) -> pa.Table:
        texts = table.column("bytes").to_pylist()
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        windows = sizes - length + 1
        row = np.repeat(np.arange(len(texts)), windows)
        place = np.arange(len(row)) - np.repeat(np.cumsum(windows) - windows, windows)
        factor = previous_factors(np.frombuffer(b"".join(texts), np.uint8), np.repeat(np.cumsum(sizes) - sizes, windows) + place, length)
        found = factor >= 0
        found[factor[found]] = True  # an earlier copy is covered too
        row, place = row[found], place[found]
        own, start = np.unique(row, return_index=True)
        ends = np.append(start[1:], len(row)) - 1
        whole = table.column("whole").to_numpy()
        return pa.table({"whole": pa.array(whole[own], pa.int64()), "a": pa.array(place[start] if len(own) else [], pa.int64()), "b": pa.array(place[ends] if len(own) else [], pa.int64())})

    # windows of different k-grams differ, so about TOGETHER contexts can be ordered together
    buckets = max(1, contexts.count() // TOGETHER)
    return contexts.groupBy(F.pmod("key", F.lit(buckets)).alias("bucket")).applyInArrow(run, "whole long, a long, b long")


def _compare_hot(contexts: DataFrame, length: int) -> DataFrame:
    """The same for k-grams of very many states: windows are counted by fingerprint across all tasks."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for whole, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                h = Hashes(text).windows(length)
                yield pa.RecordBatch.from_arrays([_signed(h), pa.array([whole] * len(h), pa.int64()), pa.array(np.arange(len(h)))], ["h", "whole", "at"])

    windows = contexts.select("whole", "bytes").mapInArrow(run, "h long, whole long, at long")
    often = windows.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h")
    return windows.join(often, "h").groupBy("whole").agg(F.min("at").alias("a"), F.max("at").alias("b"))


def repeated_spans(docs: DataFrame, length: int = LENGTH, limit: int = GROUP, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All rows of docs: the id, the text as bytes (text), and spans: array<struct<start, end>> of its
    bytes covered by strings of `length` bytes that also start anywhere else in docs.

    Exact up to collisions of 64-bit hashes.  Null text is empty and has no span; copies of a text, also
    in rows with equal or null ids, are different places; an empty table gives an empty result; other
    columns are ignored.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    texts = docs.select(F.xxhash64(text).alias("row"), F.xxhash64(F.col(id_col)).alias("tag"), F.col(id_col), text.alias("text"))
    once = texts.where(F.octet_length("text") >= length).select("row", "tag", "text")
    made = stage(_state_rows(once, length), "states")
    likely = stage(_likely(made), "likely", tidy=True)
    wanted = stage(_wanted(likely), "wanted", tidy=True)
    contexts = stage(_contexts(sieve(once, wanted, "row"), wanted, length), "contexts", tidy=True)
    found = _compare(contexts.where(F.col("n") <= limit), length)
    if not contexts.where(F.col("n") > limit).isEmpty():
        found = found.union(_compare_hot(contexts.where(F.col("n") > limit), length))
    full = likely.where("times > 1").select("whole", F.lit(0).cast("long").alias("a"), F.lit(-1).cast("long").alias("b"))
    cover = stage(full.union(found.join(full.select("whole"), "whole", "left_anti").groupBy("whole").agg(F.min("a").alias("a"), F.max("b").alias("b"))), "cover", tidy=True)
    start, end = F.col("first") + F.col("a"), F.when(F.col("b") < 0, F.col("last")).otherwise(F.col("first") + F.col("b")) + length
    covered = sieve(made.select("row", "whole", "first", "last"), cover, "whole").distinct()
    edges = covered.join(cover, "whole").select("row", F.struct(start.alias("start"), end.alias("end")).alias("edge"))
    by_row = _merged(edges.groupBy("row").agg(F.collect_list("edge").alias("edges")))
    none = F.array().cast(SPANS)
    return texts.join(by_row, "row", "left").select(id_col, F.col("text").cast("binary").alias("text"), F.coalesce("spans", none).alias("spans"))


def _merged(edges: DataFrame) -> DataFrame:
    """row and spans: its edges as maximal runs in order."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            spans = []
            for found in b.column(1).to_pylist():
                out: list[dict[str, int]] = []
                for start, end in sorted((x["start"], x["end"]) for x in found):
                    if out and start <= out[-1]["end"]:
                        out[-1]["end"] = max(out[-1]["end"], end)
                    else:
                        out.append({"start": start, "end": end})
                spans.append(out)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))], ["row", "spans"])

    return edges.mapInArrow(run, f"row long, spans {SPANS}")


def cut(spanned: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The rows of repeated_spans() with kept (the bytes left), n_bytes, n_removed and n_spans."""
    id_type = spanned.schema[id_col].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            kept, size, gone, count = [], [], [], []
            for text, spans in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                at, parts = 0, []
                for s in spans:
                    parts.append(text[at : s["start"]])
                    at = s["end"]
                kept.append(b"".join([*parts, text[at:]]))
                size.append(len(text))
                gone.append(len(text) - len(kept[-1]))
                count.append(len(spans))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(kept, pa.binary()), *(pa.array(x, pa.int64()) for x in (size, gone, count))], ["id", "kept", "n_bytes", "n_removed", "n_spans"])

    return spanned.select(id_col, "text", "spans").mapInArrow(run, f"id {id_type}, kept binary, n_bytes long, n_removed long, n_spans long").withColumnRenamed("id", id_col)
