"""Fuzzy substring dedup: shared k-mer seeds, collinear chains with gap costs, aligned passages.

Seeds are the word k-mers whose hash is a multiple of EVERY, at every place.  A place is joined to the
first earlier document that has its seed and to the last one; the matches of two documents are chained
in order through a Fenwick tree, and each chain is aligned word by word on the two texts.  Where that
ends short of a passage, as for chains of one seed, the longest stretch of the chain's diagonal that meets
the rule is taken.  Places that no passage covers then ask every earlier holder of their seed, and after that every
earlier holder of a pair of seeds that stand a passage's reach apart: the words around both places are
compared in cells of bounded size, and only holders that can make a passage become links.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from operator import eq, lt

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import sieve, stage
from .words import CHUNK, U, Words, chunks, mix, per_doc

#: Words of a seed, and which share of the k-mers are seeds: one in EVERY, by hash.
K, EVERY = 4, 4
#: A passage has at least so many words on both sides, so many of 100 of them matched.
WORDS, PERCENT = 50, 80
#: Cost of a skipped word in a chain, against K for a match.
GAP = 0.075
#: Words beyond a chain's ends that the alignment may reach (WORDS for chains of one seed).
REACH = 64
#: Words within which a seed that follows itself makes a periodic stretch.
CYCLE = 16
#: Words between the two seeds of a pair.
APART = (36, 64)
#: Chains whose words are Python objects at a time.
ROWS = 256
#: Bits of a word's hash by which it is looked up among the words of another text's part.
LOOK = 11
#: Words around a place that are compared with every holder: as many as diagonal() sees of a chain of one seed.
SIDE = WORDS
#: Of these, so many agree on a seed's diagonal; of some WORDS in a row around the seed, so many agree within a
#: shift of so many words (for seeds, for pairs).  A passage of 51 to 99 words may have no better WORDS in a row than 35.
ALONG, NEAR, SHIFTS = 16, 35, (3, 10)
#: Words around a seed that may be common to all holders of it; a passage has RUN equal words in a row beyond them.
COMMON, RUN = 15, 3
#: Rows of one key that meet in one task, about; more are dealt into cells by ranges of documents.
CELL = 1 << 14
#: Pairs of places whose words are compared at a time.
PAIRS = 1 << 13


def seeds(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, place in the text and hash of every seed.  Where a seed follows itself within CYCLE words, the
    hash also counts the repeats before, so that two periodic stretches match in order."""
    at, h = words.windows(K)
    own = h % U(EVERY) == 0
    at, h = at[own], h[own]
    if len(at):
        order = np.lexsort((at, h, words.doc[at]))
        a, g, d = at[order], h[order], words.doc[at[order]]
        first = np.concatenate([[True], (g[1:] != g[:-1]) | (d[1:] != d[:-1]) | (a[1:] > a[:-1] + CYCLE)])
        n = np.arange(len(at))
        h[order] = g + (n - np.maximum.accumulate(np.where(first, n, 0))).astype(U) * U(0x9E3779B97F4A7C15)
    doc = words.doc[at]
    return doc, at - words.first[doc], h


def chain(a: np.ndarray, b: np.ndarray) -> list[list[int]]:
    """Disjoint collinear chains of matches at places (a, b), best first, as lists of their numbers.

    A match gains K, and each word skipped on either side costs GAP; a Fenwick tree over b holds, for
    prefix maxima, each chain's score with the costs up to its end paid in advance."""
    la, lb = a.tolist(), b.tolist()
    score, before = [0.0] * len(a), [-1] * len(a)
    if all(map(lt, la, la[1:])) and all(map(lt, lb, lb[1:])):  # the best to follow is always the match before, as its entry is the largest
        entry = 0.0
        for i, paid in enumerate([GAP * (x + y) for x, y in zip(la, lb, strict=True)]):
            score[i] = float(K)
            if i and entry - paid > 0:
                score[i] += entry - paid
                before[i] = i - 1
            entry = score[i] + paid
        return _traced(score, before)
    order = np.lexsort((b, a))
    ranks = np.searchsorted(np.unique(b), b) + 1
    size = int(ranks.max())
    tree: list[tuple[float, int]] = [(0.0, -1)] * (size + 1)
    lr = ranks.tolist()
    held: list[tuple[int, tuple[float, int]]] = []
    last = None
    for i in order.tolist():
        if la[i] != last:  # matches at one place do not follow each other
            for r, entry in held:
                while r <= size:
                    if entry[0] > tree[r][0] or tree[r][1] < 0:
                        tree[r] = entry
                    r += r & -r
            held, last = [], la[i]
        best, r = (0.0, -1), lr[i] - 1
        while r > 0:
            if tree[r][1] >= 0 and (best[1] < 0 or tree[r][0] > best[0]):
                best = tree[r]
            r -= r & -r
        score[i] = float(K)
        if best[1] >= 0:
            gained = best[0] - GAP * (la[i] + lb[i])
            if gained > 0:
                score[i] += gained
                before[i] = best[1]
        held.append((lr[i], (score[i] + GAP * (la[i] + lb[i]), i)))
    return _traced(score, before)


def _traced(score: list[float], before: list[int]) -> list[list[int]]:
    """Chains by their matches' scores and the match that each follows (-1: none), best first."""
    used, out = [False] * len(score), []
    for i in sorted(range(len(score)), key=lambda i: (-score[i], i)):
        own = []
        while i >= 0 and not used[i]:
            used[i] = True
            own.append(i)
            i = before[i]
        if own:
            out.append(own[::-1])
    return out


def _common(x: list[int], y: list[int]) -> int:
    """Length of the longest common subsequence: rows of the table are whole integers, one bit a word of x,
    so that a long gap costs a few integer operations for each word of y and a few bits of memory a word."""
    bits: dict[int, int] = {}
    for i, v in enumerate(x):
        bits[v] = bits.get(v, 0) | 1 << i
    full = (1 << len(x)) - 1
    row = full
    for v in y:
        hit = row & bits.get(v, 0)
        row = (row + hit | row - hit) & full
    return len(x) - row.bit_count()


def _extend(x: list[int], y: list[int], i: int, j: int, step: int, n: int) -> tuple[int, int]:
    """How far (n words at most) two texts go together from i and j on, and the matches there: match 1,
    mismatch -2, given up 8 below the best."""
    score = best = length = hits = good = 0
    for k in range(1, n + 1):
        if x[i] == y[j]:
            score, good = score + 1, good + 1
            if score > best:
                best, length, hits = score, k, good
        else:
            score -= 2
            if score < best - 8:
                break
        i, j = i + step, j + step
    return length, hits


def _reach(x: list[int], y: list[int], i: int, j: int, step: int, nx: int, ny: int) -> tuple[int, int, int]:
    """The same across one or two words that only one side has, where five words match beyond; nx and ny
    are the words that there are on either side."""
    u = v = good = 0
    while True:
        n, hit = _extend(x, y, i + step * u, j + step * v, step, min(nx - u, ny - v))
        u, v, good = u + n, v + n, good + hit
        best = (0, 0, 0, 0)
        for a, b in ((1, 0), (0, 1), (2, 0), (0, 2)):
            c, d = u + a, v + b
            best = max(best, (_extend(x, y, i + step * c, j + step * d, step, min(nx - c, ny - d))[1], -a - b, a, b))
        if best[0] < 5:
            return u, v, good
        u, v = u + best[2], v + best[3]


def align(x: list[int], y: list[int], matches: list[tuple[int, int]]) -> list[tuple[int, int, int, int]]:
    """Passages (start, end, other start, other end) along a chain of matches of K words.  Gaps that
    match too little end a passage; what is no passage as a whole is parted at the gap with the most
    unmatched words, until all parts are passages or single blocks."""
    blocks, lost, cut = [[*matches[0], matches[0][0] + K, matches[0][1] + K]], [], []
    good = [0]  # words matched before each block
    for a, b in matches[1:]:
        _, _, i, j = blocks[-1]
        if a <= i or b <= j:  # overlapping seeds on one diagonal go on; others are left out
            if a - i == b - j:
                blocks[-1][2:] = max(i, a + K), max(j, b + K)
            continue
        gap_x, gap_y = x[i:a], y[j:b]
        longest = max(len(gap_x), len(gap_y))
        same = sum(map(eq, gap_x, gap_y)) if len(gap_x) == len(gap_y) else _common(gap_x, gap_y)
        if 2 * same < longest and longest > 12:
            cut.append(len(lost))
        lost.append(longest - same)
        good.append(good[-1] + i - blocks[-1][0] + same)
        blocks.append([a, b, a + K, b + K])
    edges = [-1, *cut, len(lost)]
    parts = [(e + 1, f) for e, f in zip(edges, edges[1:])][::-1]
    out: list[tuple[int, int, int, int]] = []
    while parts:
        lo, hi = parts.pop()
        (i, j, _, _), (last, _, k, m) = blocks[lo], blocks[hi]
        before, pbefore = blocks[lo - 1][2:] if lo else (0, 0)
        u, v, more = _reach(x, y, i - 1, j - 1, -1, i - before, j - pbefore)
        r, t, also = _reach(x, y, k, m, 1, len(x) - k, len(y) - m)
        start, pstart, end, pend = i - u, j - v, k + r, m + t
        hits = good[hi] - good[lo] + k - last + more + also
        if min(end - start, pend - pstart) >= WORDS and 100 * hits >= PERCENT * max(end - start, pend - pstart):
            out.append((start, end, pstart, pend))
        elif lo < hi:
            g = max(range(lo, hi), key=lost.__getitem__)
            parts += [(g + 1, hi), (lo, g)]
    return out


def diagonal(x: np.ndarray, y: np.ndarray, matches: list[tuple[int, int]]) -> list[tuple[int, int, int, int]]:
    """The longest passage without skipped words on the diagonal that most of the matches are on: of all
    stretches of WORDS words or more, PERCENT of 100 matched, that one, as (start, end, other start, other end)."""
    shifts = Counter(j - i for i, j in matches)
    d = min(shifts, key=lambda d: (-shifts[d], d))
    lo, hi = max(0, -d), min(len(x), len(y) - d)
    if hi - lo < WORDS:
        return []
    same = x[lo:hi] == y[lo + d : hi + d]
    if 100 * int(same.sum()) < PERCENT * WORDS:
        return []
    total = np.concatenate([[0], np.cumsum(np.where(same, 100 - PERCENT, -PERCENT))])
    least, most = np.minimum.accumulate(total), np.maximum.accumulate(total[::-1])[::-1]
    starts = np.flatnonzero(np.concatenate([[True], least[1:] < least[:-1]]))  # a longest stretch begins at a new minimum
    ends = np.searchsorted(-most, -total[starts], "right") - 1
    k = int((ends - starts).argmax())
    start, end = int(starts[k]), int(ends[k])
    own = np.flatnonzero(same[start:end])
    if end - start < WORDS or not len(own):
        return []
    start, end = start + int(own[0]), start + int(own[-1]) + 1  # words that differ at the ends don't count
    return [(start + lo, end + lo, start + lo + d, end + lo + d)] if end - start >= WORDS else []


def _merged(left: DataFrame, right: DataFrame, on, how: str = "inner") -> DataFrame:
    """A join by sorting.  Sizes of staged files say little of their rows in memory (sorted ids compress
    well), so a join that Spark chose by them could gather far more on the driver than its limit."""
    return left.join(right.hint("merge"), on, how)


def _places(rows: DataFrame) -> DataFrame:
    """rows: seed, doc, at.  The places of seeds that several documents have, with one and last (place in
    the first and in the last earlier document) and more (whether yet other places are earlier).

    Rows are sorted by seed, document and place and read as a stream.  What is carried from batch to batch is
    the seed's first place, the last one before the document at hand, and that document's own places, so a
    seed of any number of documents needs no memory."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64))
        held, ghosts, before = none, 0, 0  # rows carried, how many of them are only looked at, rows before the carried document

        def told(cols, ghosts: int, before: int, upto: int) -> pa.RecordBatch:
            seed, doc, at = cols
            n = np.arange(len(seed))
            new = np.concatenate([[True], seed[1:] != seed[:-1]])
            group = np.maximum.accumulate(np.where(new, n, 0))
            run0 = np.maximum.accumulate(np.where(new | np.concatenate([[True], doc[1:] != doc[:-1]]), n, 0))
            ends = np.append(np.flatnonzero(new)[1:], len(seed)) - 1
            several = (doc[ends] != doc[group[ends]])[np.cumsum(new) - 1]
            first = run0 == group
            prior = np.maximum(run0 - 1, 0)
            count = run0 - group + np.where(group == 0, before - ghosts, 0)
            same = (doc[prior] == doc[group]) & (at[prior] == at[group])
            more = ~first & (count > np.where(same, 1, 2))
            own = np.flatnonzero(several & (n >= ghosts) & (n < upto))
            null = first[own]
            cell = lambda x, i: pa.array(x[i[own]], mask=null)
            return pa.RecordBatch.from_arrays(
                [pa.array(seed[own]), pa.array(doc[own]), pa.array(at[own].astype(np.int32)), cell(doc, group), cell(at.astype(np.int32), group), cell(doc, prior), cell(at.astype(np.int32), prior), pa.array(more[own])],
                ["seed", "doc", "at", "one_doc", "one_at", "last_doc", "last_at", "more"],
            )

        for b in batches:
            if not b.num_rows:
                continue
            cols = tuple(np.concatenate([h, c.to_numpy().astype(np.int64)]) for h, c in zip(held, b.columns, strict=True))
            seed, doc, _ = cols
            g = int(np.searchsorted(-(seed[::-1] == seed[-1]).astype(np.int8), 0))
            start = len(seed) - g  # where the last seed begins
            r = len(doc) - int(np.searchsorted(-(doc[start:][::-1] == doc[-1]).astype(np.int8), 0))  # and its last document
            yield told(cols, ghosts, before, r)
            # rows of the last seed before its last document; looked-at rows stood for some that are counted in before
            so_far = (r - start) + (before - ghosts if start == 0 else 0)
            keep = sorted({start, r - 1} if r > start else set())
            held = tuple(np.concatenate([c[keep], c[r:]]) if keep else c[r:] for c in cols)
            ghosts, before = len(keep), so_far
        if len(held[0]):
            yield told(held, ghosts, before, len(held[0]))

    schema = "seed long, doc long, at int, one_doc long, one_at int, last_doc long, last_at int, more boolean"
    return rows.repartition("seed").sortWithinPartitions("seed", "doc", "at").mapInArrow(run, schema)


def _links(places: DataFrame) -> DataFrame:
    """doc, at, partner, pat: each place with the first and the last earlier one."""
    one, last = (F.struct(F.col(f"{x}_doc").alias("doc"), F.col(f"{x}_at").alias("at")) for x in ("one", "last"))
    both = F.when(F.expr("one_doc = last_doc and one_at = last_at"), F.array(one)).otherwise(F.array(one, last))
    return places.where("one_doc is not null").select("doc", "at", F.explode(both).alias("p")).select("doc", "at", F.col("p.doc").alias("partner"), F.col("p.at").alias("pat"))


def _uncovered(rows: DataFrame, found: DataFrame, places: tuple[str, ...]) -> DataFrame:
    """rows, of which at least one place (a seed's first word) lies in no passage found of their doc."""
    spans = found.groupBy("doc").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    inside = lambda c: F.exists("spans", lambda s: (s.start <= F.col(c)) & (F.col(c) + K <= s.end))
    whole = inside(places[0])
    for c in places[1:]:
        whole = whole & inside(c)
    return _merged(rows, spans, "doc", "left").where(~F.coalesce(whole, F.lit(False))).drop("spans")


def _holders(places: DataFrame, found: DataFrame) -> DataFrame:
    """seed, doc, at, ask: all places of the seeds that a place asks for which no passage found covers and which
    has further holders; ask marks such places."""
    open_places = stage(_uncovered(places.where("more"), found, ("at",)).select("seed", "doc", "at"), "open")
    seeds_asked = open_places.select("seed").distinct()
    rows = _merged(sieve(places.select("seed", "doc", "at"), open_places, "seed"), seeds_asked, "seed", "left_semi")
    return _merged(rows, open_places.withColumn("ask", F.lit(True)), ["seed", "doc", "at"], "left").withColumn("ask", F.coalesce("ask", F.lit(False)))


def _pairs(places: DataFrame, found: DataFrame) -> DataFrame:
    """pair, doc, at, at2, ask, nth: pairs of seeds that several documents have, with the number of the
    document among them; ask marks those with a place that no passage found covers and that has further
    holders."""
    rows = _holders(places, found)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def told(cols, upto: int) -> pa.RecordBatch:
            doc, at, seed, ask = cols
            place = np.cumsum(np.concatenate([[False], doc[1:] != doc[:-1]])) * (1 << 32) + at
            low, high = np.searchsorted(place, place[:upto] + APART[0]), np.searchsorted(place, place[:upto] + APART[1], "right")
            i = np.repeat(np.arange(upto), high - low)
            j = np.arange(len(i)) - np.repeat(np.cumsum(high - low) - high, high - low)
            pair = mix(mix(seed[i].view(U)) * U(3) + seed[j].view(U))
            return pa.RecordBatch.from_arrays([pa.array(c) for c in (pair.view(np.int64), doc[i], at[i].astype(np.int32), at[j].astype(np.int32), ask[i] | ask[j])], ["pair", "doc", "at", "at2", "ask"])

        held = None
        for b in batches:
            if not b.num_rows:
                continue
            cols = [c.to_numpy(zero_copy_only=False) for c in b.columns]
            cols = cols if held is None else [np.concatenate(x) for x in zip(held, cols, strict=True)]
            waits = (cols[0] == cols[0][-1]) & (cols[1] >= cols[1][-1] - APART[1])  # the next batch may hold partners
            cut = int(waits.argmax())
            yield told(cols, cut)
            held = [c[cut:] for c in cols]
        if held is not None:
            yield told(held, len(held[0]))

    rows = rows.select("doc", F.col("at").cast("long").alias("at"), "seed", "ask").repartition("doc").sortWithinPartitions("doc", "at")
    pairs = stage(rows.mapInArrow(run, "pair long, doc long, at int, at2 int, ask boolean"), "all_pairs")
    several = pairs.groupBy("pair").agg(F.min("doc").alias("low"), F.max("doc").alias("high"), F.max("ask").alias("any")).where("low < high and any").select("pair")
    return _merged(pairs, several, "pair").withColumn("nth", F.dense_rank().over(Window.partitionBy("pair").orderBy("doc")))


def _narrow(words: np.ndarray) -> np.ndarray:
    """8 bits of words' hashes, without 0 and 255, which stand for what is beyond a text's ends."""
    return np.clip(words.astype(np.uint8), 1, 254)


def _contexts(hashes: DataFrame, rows: DataFrame) -> DataFrame:
    """rows: key, doc, at, at2, ask.  Adds words (a byte for each of the SIDE words before a place, its K words and the
    SIDE words after it; 0 beyond the text's ends), left and right (how many of these there are), own, skip and leads.

    own tells the key of the place before in the text (for pairs, of that with its second seed as far away) and all
    words since, where that is within SIDE words; skip is the same where that place asks, and leads marks such places.
    Where skip and own are equal, both texts go on alike from the place before, whose comparison holds for this one too."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = np.arange(2 * SIDE + K)
        for b in batches:
            if not b.num_rows:
                continue
            data, start, size = _bytes(b.column(1))
            hashes = data.view(np.uint16)
            counts = pc.list_value_length(b.column(2)).to_numpy()
            apart, at, key, at2, ask = (c.to_numpy(zero_copy_only=False) for c in b.column(2).flatten().flatten())
            row = np.repeat(np.arange(b.num_rows), counts)
            for i in range(0, len(at), CHUNK // len(span)):
                end = min(len(at), i + CHUNK // len(span))
                k = np.arange(max(i - 1, 0), min(len(at), end + 1))  # with the rows before and after
                place = at[k, None].astype(np.int64) - SIDE + span
                there = (place >= 0) & (place < size[row[k], None] // 2)
                words = np.where(there, _narrow(hashes[np.where(there, start[row[k], None] // 2 + place, 0)]), np.uint8(0))
                gap = np.where((row[k[1:]] == row[k[:-1]]) & (apart[k[1:]] == apart[k[:-1]]), at[k[1:]] - at[k[:-1]], 0)
                since = mix(key[k[:-1]].view(U))
                for n in range(SIDE, 0, -1):
                    since = np.where(gap >= n, (since + words[1:, SIDE - n]) * U(0xD6E8FEB86659FD93) + U(1), since)
                own = np.concatenate([np.zeros(1, U), np.where((gap > 0) & (gap <= SIDE), mix(since) | U(1), U(0))])
                skip = np.where(np.concatenate([[False], ask[k[:-1]]]), own, U(0))
                leads = np.concatenate([skip[1:] != 0, [False]])
                new = slice(i - k[0], end - k[0])
                cells = pa.Array.from_buffers(pa.binary(), end - i, [None, pa.py_buffer((np.arange(end - i + 1) * len(span)).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(words[new]))])
                left, right = (x.sum(axis=1).astype(np.int32) for x in (there[:, :SIDE], there[:, SIDE + K :]))
                more = (pa.array(c[new]) for c in (left, right, own.view(np.int64), skip.view(np.int64), leads))
                yield pa.RecordBatch.from_arrays([pa.array(key[i:end]), b.column(0).take(pa.array(row[i:end])), *(pa.array(c[i:end]) for c in (at, at2, ask)), *more, cells], ["key", "doc", "at", "at2", "ask", "left", "right", "own", "skip", "leads", "words"])

    asks = rows.groupBy("doc").agg(F.array_sort(F.collect_list(F.struct((F.col("at2") - F.col("at")).alias("apart"), "at", "key", "at2", "ask"))).alias("asks"))
    schema = "key long, doc long, at int, at2 int, ask boolean, left int, right int, own long, skip long, leads boolean, words binary"
    return _merged(hashes, asks, "doc").select("doc", "hashes", "asks").mapInArrow(run, schema)


def _cells(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """rows (key, doc, ask and more; keys has key and doc of them) with cell, asks and holds.  The documents of a key are cut into ranges, one for each
    CELL rows; every two ranges are a cell, in which the asking rows of the later one meet all rows of the earlier one."""
    sizes = keys.groupBy("key").agg(F.ceil(F.count("*") / CELL).cast("int").alias("_n"), F.min("doc").alias("_low"), F.max("doc").alias("_high")).where("_low < _high")
    dealt = _merged(rows, sizes, "key").withColumn("_own", F.least(F.col("_n") - 1, F.floor((F.col("doc") - F.col("_low")) / (F.col("_high") - F.col("_low") + 1.0) * F.col("_n")).cast("int")))
    cell = lambda late, early: (late * F.col("_n") + early).alias("cell")
    held = F.transform(F.sequence("_own", F.col("_n") - 1), lambda i: F.struct(cell(i, F.col("_own")), (F.col("ask") & (i == F.col("_own"))).alias("asks"), F.lit(True).alias("holds")))
    asked = F.transform(F.sequence(F.lit(0), F.col("_own") - 1), lambda j: F.struct(cell(F.col("_own"), j), F.lit(True).alias("asks"), F.lit(False).alias("holds")))
    alone = F.array(F.struct(F.lit(0).alias("cell"), F.col("ask").alias("asks"), F.lit(True).alias("holds")))
    several = F.when(F.col("ask") & (F.col("_own") > 0), F.concat(held, asked)).otherwise(held)
    return dealt.select(*rows.columns, F.inline(F.when(F.col("_n") == 1, alone).otherwise(several))).drop("ask")


def _promising(x: np.ndarray, y: np.ndarray, shift: int) -> np.ndarray:
    """Which rows of two tables of words may hold a passage: WORDS in a row around the seed, NEAR of which stand in y
    too, shift words away at most."""
    wide = np.zeros((len(y), y.shape[1] + 2 * shift), np.uint8)
    wide[:, shift : shift + y.shape[1]] = y
    same = x == y
    for d in range(2 * shift + 1):
        same |= x == wide[:, d : d + x.shape[1]]
    total = np.zeros((len(x), x.shape[1] + 1), np.uint8)
    np.cumsum(same, axis=1, out=total[:, 1:], dtype=np.uint8)
    first = SIDE + K - WORDS  # the stretches that hold the seed
    return (total[:, first + WORDS : SIDE + WORDS + 1] - total[:, first : SIDE + 1]).max(axis=1) >= NEAR


def _bits(words: np.ndarray) -> np.ndarray:
    """The 4 low bits of every word of rows of at most 128 words: for each bit, two rows that hold 64 places a cell."""
    out = np.zeros((8, len(words)), U)
    for k in range(4):
        cells = np.zeros((len(words), 16), np.uint8)
        cells[:, : (words.shape[1] + 7) // 8] = np.packbits(words >> k & 1, axis=1)
        out[2 * k : 2 * k + 2] = cells.view(U).T
    return out


def _unlike(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """At how many places (at most) the words of each row of x and each row of y differ, both as _bits() gives them.  A few
    ns a pair; equal words are never counted, one in 16 that differ isn't either."""
    total = 0
    for half in (0, 1):
        unlike = x[half, :, None] ^ y[half]
        for k in range(2 + half, len(x), 2):
            unlike |= x[k, :, None] ^ y[k]
        total = total + np.bitwise_count(unlike)
    return total


def _runs(asking: np.ndarray, holding: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For slices of rows of asking: which of them have runs in common with too many rows of holding to tell these apart, and
    for the others, pairs of a row of asking and one of holding (numbers in either) that have RUN words in a row in common,
    a seed's shift away at most, beyond COMMON words around the seed.  Of these stretches that with the most such pairs
    counts, as a line that many texts share.

    No passage without skipped words is missed that lies in the words compared.  One of n words has 0.8 n - COMMON equal words at least beyond the stretch, which 0.2 n
    words that differ and the stretch part into 0.2 n + 2 runs at most, so for n of 48 and more one run has RUN words."""

    def codes(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        w = words.astype(np.uint32)
        n = w.shape[1] - RUN + 1
        code, there = np.zeros((len(w), n), np.uint32), np.ones((len(w), n), bool)
        for k in range(RUN):
            code = code << np.uint32(8) | w[:, k : k + n]
            there &= (w[:, k : k + n] > 0) & (w[:, k : k + n] < 255)
        return code << np.uint32(7) | np.arange(n, dtype=np.uint32), there

    code, there = codes(holding)
    held = np.sort(code[there].astype(U) << U(32) | np.nonzero(there)[0].astype(U))
    held, row = (held >> U(32)).astype(np.uint32), (held & U(0xFFFFFFFF)).astype(np.int64)
    shift, free = np.uint32(SHIFTS[0]), COMMON - K
    lefts = np.arange(free + 1)
    for k in range(0, len(asking), 2048):
        code, there = codes(asking[k : k + 2048])
        at = np.flatnonzero(there)
        at = at[np.argsort(code.ravel()[at])]  # searched in order
        place = np.minimum(code.ravel()[at] & np.uint32(127), shift)
        low, size = np.zeros(code.size, np.int64), np.zeros(code.size, np.int64)
        low[at] = np.searchsorted(held, code.ravel()[at] - place)
        size[at] = np.searchsorted(held, code.ravel()[at] + shift, "right") - low[at]
        size = size.reshape(code.shape)
        upto = np.concatenate([np.zeros((len(size), 1), np.int64), np.cumsum(size, axis=1)], axis=1)
        left = (upto[:, SIDE + K + free - lefts] - upto[:, SIDE - lefts - RUN + 1]).argmax(axis=1)[:, None]
        place = np.arange(size.shape[1])
        size[(place > SIDE - left - RUN) & (place < SIDE + K + free - left)] = 0
        total = size.sum(axis=1)
        heavy = 2 * total > len(holding)
        size[heavy] = 0
        ends, i, pairs = np.cumsum(np.where(heavy, 0, total)), 0, []
        while i < len(size):
            j = max(i + 1, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + 64 * PAIRS, "right")))
            n = size[i:j].ravel()
            own = np.flatnonzero(n)
            n, first = n[own], low[i * size.shape[1] : j * size.shape[1]][own]
            other = row[np.repeat(first - np.cumsum(n) + n, n) + np.arange(n.sum())]
            pairs.append(np.unique(np.repeat(own // size.shape[1] + k + i, n) * len(holding) + other))
            i = j
        yield np.flatnonzero(heavy) + k, *np.divmod(np.concatenate(pairs), len(holding))


def _met(new: np.ndarray, upto: np.ndarray, asks: np.ndarray, fit, likely=None, runs=None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Numbers of asking rows and of the earlier rows of their cells (new marks a cell's first row, upto is the
    first row of a row's document) for which fit holds, at most PAIRS at a time.
    In large cells runs (for asking rows and a slice of rows: as _runs() gives them) and, for rows that it can't tell apart,
    likely (for some rows and a slice of rows: which of all their pairs) tell first for which pairs fit may hold."""
    n = np.arange(len(new))
    group = np.maximum.accumulate(np.where(new, n, 0))
    a = np.flatnonzero(asks & (upto > group))
    size = upto[a] - group[a]
    few, many = a[size < 256], a[size >= 256]
    ends = np.cumsum(size[size < 256])
    for lo in range(0, int(ends[-1]) if len(ends) else 0, PAIRS):
        one = np.arange(lo, min(lo + PAIRS, int(ends[-1])))
        k = np.searchsorted(ends, one, "right")
        i, j = few[k], upto[few[k]] - (ends[k] - one)
        own = fit(i, j)
        yield i[own], j[own]
    edges = np.concatenate([[0], np.flatnonzero(np.diff(group[many])) + 1, [len(many)]]) if len(many) else [0]
    for lo, hi in zip(edges[:-1], edges[1:], strict=True):  # the asking rows of one cell
        first, last, left = group[many[lo]], upto[many[hi - 1]], many[lo:hi]
        if runs:
            heavy = [left[:0]]
            for rest, x, y in runs(many[lo:hi], slice(first, last)):
                heavy.append(many[lo + rest])
                i, j = many[lo + x], y + first
                keep = j < upto[i]
                keep[keep] = fit(i[keep], j[keep])
                i, j = i[keep], j[keep]
                for q in range(0, len(i), PAIRS):
                    yield i[q : q + PAIRS], j[q : q + PAIRS]
            left = np.concatenate(heavy)
        step = max(1, 8 * PAIRS // int(last - first))
        for k in range(0, len(left), step):
            own = left[k : k + step, None]
            other = np.arange(first, upto[own[-1, 0]])[None, :]
            near = other < upto[own]
            if likely:
                near &= likely(own[:, 0], slice(first, first + near.shape[1]))
            most = 4 * np.count_nonzero(near) > near.size
            if most:
                near &= fit(own, other)
            met = np.flatnonzero(near)
            for q in range(0, len(met), PAIRS):
                x, y = np.divmod(met[q : q + PAIRS], near.shape[1])
                i, j = own[x, 0], y + first
                keep = slice(None) if most else fit(i, j)
                yield i[keep], j[keep]


def _asked(hashes: DataFrame, rows: DataFrame, pairs: bool = False) -> DataFrame:
    """doc, at, at2, partner, pat, pat2, sure, alone: links of asking rows (key, doc, at, at2, ask) with earlier documents that
    have the key and may make a passage around the place.  A place that does not lead gets one sure link in a cell, with the
    earliest document whose words make a passage over it as they are; where there is none, and for pairs, it gets all
    that may.  alone marks links that may make a passage as a chain of their own."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def told(cols) -> pa.RecordBatch:
            key, cell, doc, at, at2, left, right, own, skip, leads, asks, holds, words = cols
            left, right = left.astype(np.uint8), right.astype(np.uint8)
            new = np.concatenate([[True], (key[1:] != key[:-1]) | (cell[1:] != cell[:-1])])
            upto = np.maximum.accumulate(np.where(new | np.concatenate([[True], doc[1:] != doc[:-1]]), np.arange(len(key)), 0))  # holders are earlier documents
            mine = np.where(words == 0, np.uint8(255), words)  # what is beyond a text's ends is equal to nothing

            def fit(i: np.ndarray, j: np.ndarray) -> np.ndarray:
                out = holds[j] & ((skip[i] == 0) | (skip[i] != own[j]))
                return out if pairs else out & (np.minimum(left[i], left[j]) + np.minimum(right[i], right[j]) + K >= NEAR)

            likely = runs = None
            if not pairs:
                asking, holding = _bits(mine), _bits(words)
                likely = lambda i, j: _unlike(asking[:, i], holding[:, j]) <= words.shape[1] - ALONG
                runs = lambda i, j: _runs(mine[i], np.where(holds[j, None], words[j], np.uint8(0)))

            out: list[np.ndarray] = [np.zeros((3, 0), np.int64)]
            for i, j in _met(new, upto, asks, fit, likely, runs):
                same = (np.take(mine, i, axis=0) == np.take(words, j, axis=0)).view(U)
                total = (np.einsum("ij->i", same) * U(0x0101010101010101)) >> U(56)  # equal words, eight a lane
                if not pairs:
                    i, j, total = (c[total >= ALONG] for c in (i, j, total))
                fair = _promising(mine[i], words[j], SHIFTS[pairs])
                out.append(np.stack([i[fair], j[fair], total[fair].astype(np.int64)]))
            i, j, total = np.concatenate(out, axis=1)
            order = np.lexsort((j, i))
            i, j, total = i[order], j[order], total[order]
            best = np.full(len(key), -1)
            for k in np.flatnonzero((100 * total >= PERCENT * WORDS) & ~leads[i]).tolist() if not pairs else ():
                if best[i[k]] < 0 and any(s <= SIDE and SIDE + K <= e for s, e, _, _ in diagonal(mine[i[k]], words[j[k]], [(SIDE, SIDE)])):
                    best[i[k]] = j[k]
            keep = (best[i] < 0) | (best[i] == j)
            i, j = i[keep], j[keep]
            alone = pairs | (100 * total[keep] >= PERCENT * WORDS)  # as hopeful() asks
            return pa.RecordBatch.from_arrays([pa.array(c) for c in (doc[i], at[i], at2[i], doc[j], at[j], at2[j], best[i] >= 0, alone)], ["doc", "at", "at2", "partner", "pat", "pat2", "sure", "alone"])

        held, kept = None, []
        for b in batches:
            if not b.num_rows:
                continue
            data, start, _ = _bytes(b.column(12))
            width = 2 * SIDE + K
            cols = [c.to_numpy(zero_copy_only=False) for c in b.columns[:12]] + [data[start[0] : start[0] + b.num_rows * width].reshape(-1, width)]
            kept.append(cols)
            if cols[0][0] == cols[0][-1] and cols[1][0] == cols[1][-1] and (held is None or (held[0] == cols[0][-1] and held[1] == cols[1][-1])):
                held = (cols[0][-1], cols[1][-1])  # one cell goes on
                continue
            cols = [np.concatenate(x) for x in zip(*kept, strict=True)]
            cut = int(((cols[0] == cols[0][-1]) & (cols[1] == cols[1][-1])).argmax())
            if cut:
                yield told([c[:cut] for c in cols])
            kept, held = [[c[cut:].copy() for c in cols]], (cols[0][-1], cols[1][-1])
        if kept:
            yield told([np.concatenate(x) for x in zip(*kept, strict=True)])

    cells = _cells(_contexts(hashes, rows), rows).select("key", "cell", "doc", "at", "at2", "left", "right", "own", "skip", "leads", "asks", "holds", "words")
    dealt = cells.repartition("key", "cell").sortWithinPartitions("key", "cell", "doc", "at")
    return dealt.mapInArrow(run, "doc long, at int, at2 int, partner long, pat int, pat2 int, sure boolean, alone boolean")


def _linked(hashes: DataFrame, links: DataFrame, rows: DataFrame) -> DataFrame:
    """Passages along links as _asked() makes them (staged).  Sure links whose place the chain of all links of two
    documents leaves uncovered stand alone.  Documents with a passage are chained again along all their common places of
    rows (staged), as a passage goes on where places left their comparison to the one before."""
    both = F.array_distinct(F.array(F.struct("at", "pat"), F.struct(F.col("at2").alias("at"), F.col("pat2").alias("pat"))))
    each = links.select("doc", "partner", "alone", F.explode(both).alias("m")).groupBy("doc", "m.at", "partner", "m.pat").agg(F.max("alone").alias("alone"))
    got = stage(_passages(hashes, _chains(each, True), few=True), "further", tidy=True)
    left = stage(_uncovered(links.where("sure"), got, ("at",)), "alone")
    if not left.isEmpty():
        got = got.union(_alone(hashes, left))
    if got.isEmpty():
        return got
    both = got.select("doc", "partner").distinct()
    return got.union(stage(_passages(hashes, _chains(_in_common(rows, both), True), few=True), "further"))


def _in_common(rows: DataFrame, both: DataFrame) -> DataFrame:
    """doc, at, partner, pat: the places of rows (key, doc, at) with one key in both documents of pairs (doc, partner).  A
    document's places go with a pair as one row, not as many as there are places."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ends = np.cumsum(sum(pc.list_value_length(b.column(k)).to_numpy().astype(np.int64) for k in (2, 3)))
            i = 0
            while i < b.num_rows:
                j = max(i + 1, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + CHUNK, "right")))
                own = b.slice(i, j - i)
                (row, key, at), (prow, pkey, pat) = ((np.repeat(np.arange(j - i), pc.list_value_length(c).to_numpy()), *(x.to_numpy() for x in c.flatten().flatten())) for c in (own.column(2), own.column(3)))
                keys, code = np.unique(np.concatenate([key, pkey]), return_inverse=True)
                code, pcode = code[: len(key)] + row * len(keys), code[len(key) :] + prow * len(keys)
                order = np.argsort(pcode)
                low, high = (np.searchsorted(pcode[order], code, side) for side in ("left", "right"))
                x = np.repeat(np.arange(len(code)), high - low)
                y = order[np.arange(len(x)) - np.repeat(np.cumsum(high - low) - high, high - low)]
                yield pa.RecordBatch.from_arrays([own.column(0).take(pa.array(row[x])), pa.array(at[x]), own.column(1).take(pa.array(row[x])), pa.array(pat[y])], ["doc", "at", "partner", "pat"])
                i = j

    wanted = both.select("doc").union(both.select("partner")).distinct()
    listed = stage(_merged(rows.select("doc", "key", "at"), wanted, "doc", "left_semi").groupBy("doc").agg(F.collect_set(F.struct("key", "at")).alias("places")), "listed")
    met = _merged(_merged(both, listed, "doc"), listed.select(F.col("doc").alias("partner"), F.col("places").alias("others")), "partner")
    return met.select("doc", "partner", "places", "others").mapInArrow(run, "doc long, at int, partner long, pat int")


def _alone(hashes: DataFrame, left: DataFrame) -> DataFrame:
    """Passages along single links."""
    alone = left.select("doc", "partner", *(F.array(F.col(c).cast("long")).alias(to) for c, to in (("at", "a"), ("pat", "b"))))
    return stage(_passages(hashes, alone, few=True), "further")


def _further(hashes: DataFrame, places: DataFrame, found: DataFrame) -> DataFrame:
    """Passages with further documents: those for which places that no passage found covers ask.  Every earlier holder of
    the seed is compared, then every one of a pair of seeds for what is still uncovered."""
    rows = stage(_holders(places, found).select(F.col("seed").alias("key"), "doc", "at", F.col("at").alias("at2"), "ask"), "holders", tidy=True)
    if rows.isEmpty():
        return found
    found = found.union(_linked(hashes, stage(_asked(hashes, rows), "links", tidy=True), rows))
    asked = rows.select(F.col("key").alias("seed"), "doc", "at", F.col("ask").alias("more"))  # what is still open is among these
    pairs = stage(_pairs(asked, found).select(F.col("pair").alias("key"), "doc", "at", "at2", F.col("ask").alias("ask")), "pairs", tidy=True)
    if pairs.isEmpty():
        return found
    return found.union(_linked(hashes, stage(_asked(hashes, pairs, pairs=True), "links", tidy=True), rows))


def _chains(links: DataFrame, single: bool) -> DataFrame:
    """doc, partner, a, b (places of a chain's matches); single takes chains of one match too, where links have alone,
    those of such links.  Links are sorted by a hash of their pair and read as a stream; the matches of one pair of
    documents are worked on together."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def told(cols) -> pa.RecordBatch:
            _, doc, partner, at, pat, fair = cols
            order = np.lexsort((pat, at, partner, doc))
            doc, partner, at, pat, fair = (c[order] for c in (doc, partner, at, pat, fair))
            new = np.concatenate([[True], (doc[1:] != doc[:-1]) | (partner[1:] != partner[:-1])])
            first = np.flatnonzero(new)
            sizes = np.diff(np.append(first, len(doc)))
            x, y = np.diff(at), np.diff(pat)
            near = (x > 0) & (y > 0) & (GAP * (x + y) < K)  # where every match gains on the one before, all are one chain
            whole = np.logical_and.reduceat(np.concatenate([[True], new[1:] | near]), first)
            alone = whole & ((sizes > 1) | (single & (fair[first] > 0)))
            members: list[list[int]] = []
            for i, n in zip(first[~whole].tolist(), sizes[~whole].tolist(), strict=True):
                members += [[i + k for k in own] for own in chain(at[i : i + n], pat[i : i + n]) if len(own) > 1 or single and fair[i + own[0]]]
            flat = np.concatenate([np.flatnonzero(np.repeat(alone, sizes)), np.array([i for own in members for i in own], np.int64)])
            ends = np.concatenate([[0], np.cumsum(np.concatenate([sizes[alone], np.array([len(own) for own in members], np.int64)]))]).astype(np.int32)
            head = flat[ends[:-1]]
            lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(x[flat])) for x in (at, pat)]
            return pa.RecordBatch.from_arrays([pa.array(doc[head]), pa.array(partner[head]), *lists], ["doc", "partner", "a", "b"])

        held = None
        for b in batches:
            if not b.num_rows:
                continue
            cols = [c.to_numpy(zero_copy_only=False).astype(np.int64) for c in b.columns]
            cols = cols if held is None else [np.concatenate(x) for x in zip(held, cols, strict=True)]
            open_pair = cols[0] == cols[0][-1]
            cut = int(np.flatnonzero(~open_pair)[-1]) + 1 if not open_pair.all() else 0
            if cut:
                yield told([c[:cut] for c in cols])
            held = [c[cut:] for c in cols]
        if held is not None:
            yield told(held)

    rows = links.select("doc", "partner", "at", "pat", F.col("alone") if "alone" in links.columns else F.lit(True).alias("alone")).repartition("doc", "partner").select(F.xxhash64("doc", "partner").alias("pair"), "*").sortWithinPartitions("pair")
    return rows.mapInArrow(run, "doc long, partner long, a array<long>, b array<long>")


def _hashed(texts: DataFrame) -> DataFrame:
    """doc, hashes: 16 bits of the hash of every word, two bytes a word, which move instead of texts."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for own, part in chunks(batches, 1):
            words = Words(own, lower=True)
            low, first = words.hash.astype(np.uint16), words.first
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array([low[i:j].tobytes() for i, j in zip(first[:-1], first[1:], strict=True)], pa.binary())], ["doc", "hashes"])

    return texts.select("doc", "text").mapInArrow(run, "doc long, hashes binary")


def _parts(hashes: DataFrame, asked: DataFrame) -> DataFrame:
    """hashes as _hashed() makes them; asked: doc, asks (array of chain, side, start, end, narrow).  chain, side, start, words (16 bits of
    each word's hash, 8 where narrow)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            data, at, size = _bytes(b.column(0))
            hashes, (chain, side, start, end, narrow) = data.view(np.uint16), b.column(1).flatten().flatten()
            doc = np.repeat(np.arange(b.num_rows), pc.list_value_length(b.column(1)).to_numpy())
            start = np.maximum(start.to_numpy(), 0)
            n = np.clip(np.minimum(end.to_numpy(), size[doc] // 2) - start, 0, None)
            narrow, first = narrow.to_numpy(zero_copy_only=False), at[doc] // 2 + start
            for low in (False, True):
                own = np.flatnonzero(narrow == low)
                ends, i = np.cumsum(n[own]), 0
                while i < len(own):
                    j = max(i + 1, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + CHUNK, "right")))
                    k = own[i:j]
                    bounds = np.concatenate([[0], np.cumsum(n[k])])
                    words = hashes[np.repeat(first[k] - bounds[:-1], n[k]) + np.arange(bounds[-1])]
                    words = _narrow(words) if low else words
                    cells = pa.Array.from_buffers(pa.binary(), len(k), [None, pa.py_buffer((bounds * words.itemsize).astype(np.int32)), pa.py_buffer(words)])
                    yield pa.RecordBatch.from_arrays([chain.take(pa.array(k)), side.take(pa.array(k)), pa.array(start[k]), cells], ["chain", "side", "start", "words"])
                    i = j

    return _merged(hashes, asked, "doc").select("hashes", "asks").mapInArrow(run, "chain long, side int, start long, words binary")


def hopeful(batch: pa.RecordBatch, wide: bool = False) -> np.ndarray:
    """Which rows (columns as _together() gives them) may hold a passage: chains of several seeds, and those of one
    seed whose diagonal has enough equal words, which diagonal() asks too.  All rows at once: each pair of
    diagonals is one run of bytes (of pairs of bytes where wide) of either column, and equal ones are counted by run."""
    _, _, a, b, xs, x, ys, y = batch.columns
    out = pc.greater(pc.list_value_length(a), 1).to_numpy(zero_copy_only=False)
    one = np.flatnonzero(~out)
    if not len(one):
        return out
    i, j = (pc.list_element(c.take(pa.array(one)), 0).to_numpy() - s.to_numpy()[one] for c, s in ((a, xs), (b, ys)))
    back = np.minimum(i, j)
    (bx, ox, nx), (by, oy, ny) = map(_bytes, (x.take(pa.array(one)), y.take(pa.array(one))))
    if wide:
        bx, ox, nx, by, oy, ny = bx.view(np.uint16), ox // 2, nx // 2, by.view(np.uint16), oy // 2, ny // 2
    size = np.maximum(np.minimum(nx - i, ny - j) + back, 0)
    first = np.concatenate([[0], np.cumsum(size)])
    step = np.arange(first[-1]) - np.repeat(first[:-1], size)
    same = bx[np.repeat(ox + i - back, size) + step] == by[np.repeat(oy + j - back, size) + step]
    out[one] = (size >= WORDS) & (100 * per_doc(same, first) >= PERCENT * WORDS)
    return out


def sharing(batch: pa.RecordBatch) -> np.ndarray:
    """Which rows (columns as _together() gives them) may hold a passage: chains of one seed, and those of several with as
    many words as a passage matches that the other side has anywhere, by LOOK bits of their hashes (equal words are
    never missed)."""
    _, _, a, _, _, x, _, y = batch.columns
    out = np.ones(batch.num_rows, bool)
    several = np.flatnonzero(pc.greater(pc.list_value_length(a), 1).to_numpy(zero_copy_only=False))
    for i in range(0, len(several), ROWS):
        k = several[i : i + ROWS]
        sides = []
        for column in (x, y):
            data, at, size = _bytes(column.take(pa.array(k)))
            words = data[at[0] : at[-1] + size[-1]].view(np.uint16)
            sides.append((size // 2, (np.repeat(np.arange(len(k)), size // 2) << LOOK) + (words & ((1 << LOOK) - 1))))
        there = np.zeros(len(k) << LOOK, bool)
        there[sides[1][1]] = True
        out[k] = 100 * per_doc(there[sides[0][1]], np.concatenate([[0], np.cumsum(sides[0][0])])) >= PERCENT * WORDS
    return out


def _bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of a binary column, and each row's start and size."""
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return np.frombuffer(column.buffers()[2] or b"", np.uint8), ends[:-1], np.diff(ends)


def _together(rows: pa.RecordBatch) -> pa.RecordBatch:
    """Rows of whole chains, sorted (columns as in _aligned()): doc, partner, a, b and either side's start and words of those
    with both sides, a row each.  Of a side that stands there twice (its document's row does) the first counts."""
    chain, side = (rows.column(k).to_numpy() for k in (0, 1))
    first = np.flatnonzero(np.concatenate([[True], (chain[1:] != chain[:-1]) | (side[1:] != side[:-1])]))
    chain, side = chain[first], side[first]
    k = np.flatnonzero((side[:-2] == -1) & (side[2:] == 1) & (chain[:-2] == chain[2:]) & (chain[:-2] == chain[1:-1]))
    head, x, y = (pa.array(first[k + n]) for n in range(3))
    return pa.RecordBatch.from_arrays([*(rows.column(n).take(head) for n in (2, 3, 4, 5)), *(rows.column(n).take(own) for own in (x, y) for n in (6, 7))], ["doc", "partner", "a", "b", "xs", "x", "ys", "y"])


def _aligned(rows: DataFrame, wide: bool = False) -> DataFrame:
    """Passages of chains: doc, start, end, partner, pstart, pend.  rows: chain, side, doc, partner, a, b, start, words;
    a chain's own row has side -1, then both sides' words follow (wide: two bytes a word also of chains of one seed).  Rows
    are sorted and read as a stream."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def told(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            whole = _together(pa.Table.from_batches(parts).combine_chunks().to_batches()[0])
            for fit in (lambda x: hopeful(x, wide), sharing):
                whole = whole.filter(pa.array(fit(whole))) if whole.num_rows else whole
            yield from passages(whole)

        held: list[pa.RecordBatch] = []
        for b in batches:
            if not b.num_rows:
                continue
            chain = b.column(0).to_numpy()
            cut = int((chain == chain[-1]).argmax())  # the last chain may go on
            if cut:
                yield from told([*held, b.slice(0, cut)])
                held = []
            elif held and held[-1].column(0)[-1].as_py() != chain[-1]:
                yield from told(held)
                held = []
            held.append(b.slice(cut))
        if held:
            yield from told(held)

    def passages(whole: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for batch in (whole.slice(i, ROWS) for i in range(0, whole.num_rows, ROWS)):
            rows = []
            ends = np.cumsum(pc.list_value_length(batch.column(2)).to_numpy()).tolist()
            flat = [batch.column(k).flatten().to_numpy().tolist() for k in (2, 3)]
            for doc, partner, xs, x, ys, y, lo, hi in zip(*(batch.column(k).to_pylist() for k in (0, 1, 4, 5, 6, 7)), [0, *ends[:-1]], ends, strict=True):
                u, v = (np.frombuffer(w, np.uint8 if hi - lo == 1 and not wide else np.uint16) for w in (x, y))
                matches = [(i - xs, j - ys) for i, j in zip(flat[0][lo:hi], flat[1][lo:hi], strict=True)]
                for s, e, ps, pe in (align(u.tolist(), v.tolist(), matches) if hi - lo > 1 else []) or diagonal(u, v, matches):
                    rows.append((doc, s + xs, e + xs, partner, ps + ys, pe + ys))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], ["doc", "start", "end", "partner", "pstart", "pend"])

    return rows.repartition("chain").sortWithinPartitions("chain", "side").mapInArrow(run, "doc long, start long, end long, partner long, pstart long, pend long")


def _passages(hashes: DataFrame, chains: DataFrame, tidy: bool = False, few: bool = False) -> DataFrame:
    """doc, start, end, partner, pstart, pend of the passages along chains as _chains() makes them; few where
    they concern few of the documents, so that the others' words need not move and all are compared by 16 bits."""
    found = stage(chains.withColumn("chain", F.xxhash64("doc", "partner", "a", "b")), "chains", tidy)
    reach = F.when(F.size("a") == 1, WORDS).otherwise(REACH)
    ask = lambda side, doc, places: found.select(F.col(doc).alias("doc"), F.struct("chain", F.lit(side).alias("side"), (F.element_at(places, 1) - reach).cast("long").alias("start"), (F.element_at(places, -1) + K + reach).cast("long").alias("end"), (F.lit(not few) & (F.size("a") == 1)).alias("narrow")).alias("ask"))
    asked = ask(0, "doc", "a").union(ask(1, "partner", "b")).groupBy("doc").agg(F.collect_list("ask").alias("asks"))
    if few:
        asked = stage(asked, "asked")
        hashes = sieve(hashes, asked, "doc")
    own = found.select("chain", F.lit(-1).alias("side"), "doc", "partner", "a", "b")
    return _aligned(own.unionByName(_parts(hashes, asked), allowMissingColumns=True), wide=few)


def fuzzy_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc, start, end, partner, pstart, pend: word spans of passages that a document shares with an
    earlier one (smaller id).  Words are compared with A-Z lower-cased, by 16 bits of their
    hashes (8 for chains of one seed with the first or the last earlier document), so one word in 65,536 (256) that differs counts as matched.

    A passage has at least WORDS words on both sides, PERCENT of 100 matched; of passages with one
    partner, those inside another are left out.  Repeats inside one document are not passages.  Null texts are empty; rows
    with a null id are left out; rows that repeat an id must repeat its text and count once.
    """
    texts = docs.where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for own, part in chunks(batches, 1):
            doc, at, h = seeds(Words(own, lower=True))
            if len(doc):
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(part.column(0).to_numpy()[doc]), pa.array(at.astype(np.int32))], ["seed", "doc", "at"])

    places = stage(_places(texts.mapInArrow(run, "seed long, doc long, at int")), "places", tidy=True)
    hashes = stage(_hashed(texts), "hashes")
    found = stage(_passages(hashes, _chains(_links(places), True), tidy=True), "found", tidy=True)
    found = _further(hashes, places, found)
    to = F.max("end").over(Window.partitionBy("doc", "partner").orderBy("start", F.desc("end"), "pstart", "pend").rowsBetween(Window.unboundedPreceding, -1))
    return found.withColumn("to", to).where("to is null or end > to").drop("to")


def passage_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: the id, n_words, n_passages and n_removed (passages and words that
    repeat an earlier document), spans of them with partners, and n_copied (passages of the document
    that later ones repeat).  Edge cases as in fuzzy_passages()."""
    from .shared import word_count

    found = stage(fuzzy_passages(docs, id_col, text_col), "passages")
    own = found.groupBy("doc").agg(F.array_sort(F.collect_set(F.struct("start", "end", "partner"))).alias("spans"))
    copied = found.groupBy(F.col("partner").alias("doc")).agg(F.count("*").alias("n_copied"))
    rows = docs.select(F.col(id_col), word_count(F.col(text_col)).alias("n_words"))
    for side in (own, copied):
        rows = _merged(rows, side, F.col(id_col).cast("long") == F.col("doc"), "left").drop("doc")
    none = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("to"))
    covered = F.aggregate("spans", none, lambda s, x: F.struct((s.n + F.greatest(F.lit(0).cast("long"), x.end - F.greatest(s.to, x.start))).alias("n"), F.greatest(s.to, x.end).alias("to")), lambda s: s.n)
    return rows.select(id_col, "n_words", F.coalesce(F.size("spans"), F.lit(0)).cast("long").alias("n_passages"), F.coalesce(covered, F.lit(0)).cast("long").alias("n_removed"), F.coalesce("n_copied", F.lit(0)).cast("long").alias("n_copied"), "spans")
