"""MinHash near-dedup with an LSH forest.

Each tree is an order of the documents by a signature, a sequence of minimum hashes.  The documents are
sorted by each signature; neighbours in an order whose longest common prefix is deep enough are candidates.
A run of the order at one depth is a region.  Where the region at depth SHALLOW is small, that is its
depth; elsewhere it is DEPTH, so that at no size of a region a pair has less chance to meet than DEPTH
gives.  Candidates join documents to clusters.  A small cluster is checked as a whole.  In a large one,
blocks of signature neighbours are linked first; what then still lies in one region but in several
components is compared in blocks.  Links are confirmed on full sets of shingles.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .components import components
from .shared import sieve, stage
from .words import U, Words, chunks, mix

SHINGLE = 5
TREES = 32
#: Minimum hashes of a signature, and the depths of regions: SHALLOW where the region there has at most
#: FEW documents, else DEPTH.
LENGTH, SHALLOW, DEPTH, FEW = 5, 4, 5, 16
#: Documents (by weight) that are compared in one task as one group, and shingles that weigh one document.
GROUP, HEAVY = 4096, 2048
#: Orders in which the blocks of neighbours of a large cluster are linked first.
FIRST = 8
#: Values of the sketch that rules out pairs before full sets are compared, and how far below the
#: threshold its estimate may lie: about five standard deviations.
SKETCH, MARGIN = 256, 0.11

_rng = np.random.default_rng(20240601)
_TREE_HASHES = _rng.integers(0, 1 << 63, (TREES, LENGTH), np.uint64) * U(2) + U(1)
#: A signature is its tree and its minimum hashes, 16 bits each: values that differ look alike once in
#: 65,536, which may add a candidate, but equal ones always do.
_DIGIT = np.dtype(">u2")
_KEY = _DIGIT.itemsize * (1 + LENGTH)
_SKETCH_HASHES = _rng.integers(0, 1 << 63, SKETCH, np.uint64) * U(2) + U(1)


def shingle_sets(texts: list[bytes]) -> list[np.ndarray]:
    """Sorted hashes of each text's distinct shingles of five words, A-Z lower-cased; of a text with
    fewer words, one hash of them all; without words none."""
    words = Words(texts, lower=True)
    at, h = words.windows(SHINGLE)
    cuts = np.searchsorted(at, words.first)
    out = []
    for i in range(len(texts)):
        a, b = words.first[i], words.first[i + 1]
        if b - a >= SHINGLE:
            out.append(np.unique(h[cuts[i] : cuts[i + 1]]))
        elif b > a:
            whole = hashlib.blake2b(words.hash[a:b].tobytes(), digest_size=8).digest()
            out.append(np.frombuffer(whole, U))
        else:
            out.append(np.zeros(0, U))
    return out


def digest(own: np.ndarray) -> tuple[int, int]:
    """128 bits that stand for a whole set."""
    return tuple(np.frombuffer(hashlib.blake2b(own.tobytes(), digest_size=16).digest(), np.int64).tolist())


def minima(sets: list[np.ndarray], hashes: np.ndarray) -> np.ndarray:
    """The least value of each hash over each set (none empty): [hash, set]."""
    flat = np.concatenate(sets)
    starts = np.cumsum([0, *(len(s) for s in sets[:-1])])
    out = np.empty((len(hashes), len(sets)), U)
    for j, a in enumerate(hashes):
        out[j] = np.minimum.reduceat(flat * a, starts)
    return out


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """The signatures of sets (none empty) as big-endian 16-bit numbers, which sort as bytes: [set, tree, 1 + LENGTH]."""
    least = minima(sets, _TREE_HASHES.reshape(-1)).reshape(TREES, LENGTH, len(sets))
    out = np.empty((len(sets), TREES, 1 + LENGTH), _DIGIT)
    out[:, :, 0] = np.arange(TREES)
    out[:, :, 1:] = (mix(least) >> U(48)).transpose(2, 0, 1)
    return out


def link(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """Component numbers of sets under links 100 * intersection >= percent * union.  Sketches rule out
    pairs; a pair not yet connected is confirmed on the full sets, likeliest first."""
    m = len(sets)
    comp, size = np.arange(m), np.array([len(s) for s in sets])
    flat = mix(minima(sets, _SKETCH_HASHES)).astype(np.uint8).T.copy() if m > 2 else np.zeros((m, 1), np.uint8)
    least = (percent / 100 - MARGIN) * flat.shape[1] if m > 2 else 0
    step = max(1, (1 << 24) // (m * flat.shape[1]))
    for start in range(0, m - 1, step):
        block = flat[start : start + step]
        same = (block[:, None, :] == flat[None, start + 1 :, :]).sum(2, dtype=np.int32)
        i, j = np.nonzero(np.triu(same >= least) if least else np.triu(np.ones(same.shape, bool)))
        n = same[i, j]
        i, j = i + start, j + start + 1
        ok = (100 * np.minimum(size[i], size[j]) >= percent * np.maximum(size[i], size[j])) & (comp[i] != comp[j])
        i, j, n = i[ok], j[ok], n[ok]
        for k in np.argsort(-n, kind="stable"):
            a, b = int(i[k]), int(j[k])
            if comp[a] != comp[b]:
                x, y = (sets[a], sets[b]) if size[a] <= size[b] else (sets[b], sets[a])
                at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                both = int((y[at] == x).sum())
                if 100 * both >= percent * (len(x) + len(y) - both):
                    comp[comp == comp[b]] = comp[a]
    return comp


def features(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, n_shingles, d0 and d1 (digest of the set) and signatures (binary; null for an empty set)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for texts, part in chunks(batches, 1):
            sets = shingle_sets(texts)
            full = [i for i, s in enumerate(sets) if len(s)]
            blobs: list[bytes | None] = [None] * len(sets)
            if full:
                for i, own in zip(full, signatures([sets[i] for i in full]), strict=True):
                    blobs[i] = own.tobytes()
            own = np.array([digest(s) for s in sets], np.int64)
            yield pa.RecordBatch.from_arrays(
                [part.column(0).cast(pa.int64()), pa.array([len(s) for s in sets], pa.int64()), pa.array(own[:, 0]), pa.array(own[:, 1]), pa.array(blobs, pa.binary())],
                ["id", "n_shingles", "d0", "d1", "signatures"],
            )

    return docs.select(F.col(id_col).cast("long").alias("id"), text_col).mapInArrow(run, "id long, n_shingles long, d0 long, d1 long, signatures binary")


def orders(rows: DataFrame, trees: int = TREES) -> DataFrame:
    """rows: id, signatures and others.  One row a tree with key, the signature that places it there."""
    cut = F.transform(F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: F.substring("signatures", t * _KEY + 1, F.lit(_KEY)))
    return rows.withColumn("key", F.explode(cut)).drop("signatures")


def _numbers(keys: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(keys.to_pylist()), _DIGIT).reshape(len(keys), 1 + LENGTH)


def common_prefix(keys: np.ndarray) -> np.ndarray:
    """Minimum hashes that each row of sorted signatures has in common with the row before, from the first on."""
    return np.cumprod(keys[1:] == keys[:-1], axis=1).sum(1) - 1


def neighbours(rows: DataFrame) -> DataFrame:
    """rows: id, key.  Candidate pairs a, b: neighbours in a sorted order whose common prefix is as deep
    as their region asks for.  Range partitions are sorted and read as a stream, of which a worker holds one
    batch and FEW pairs at most; the first and last row of each meet in a second step, at DEPTH."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.zeros(0, np.int64)
        last, first, size, at_start = None, None, 0, True  # the row before; the first row; rows of the open region; whether it is the first one
        waiting = (none, none)  # its pairs of less than DEPTH, which count if it stays small

        def told(a: np.ndarray, b: list, edges: list, at: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(edges, pa.binary()), pa.array(at, pa.int64())], ["a", "b", "edge", "at"])

        for batch in batches:
            if not batch.num_rows:
                continue
            ids, keys = batch.column(0).to_numpy(), _numbers(batch.column(1))
            first = first or (int(ids[0]), keys[0].tobytes())
            if last is not None:
                ids, keys = np.concatenate([last[0], ids]), np.concatenate([last[1], keys])
            lcp = common_prefix(keys)
            region = np.concatenate([[0], np.cumsum(lcp < SHALLOW)])
            sizes = np.bincount(region)
            sizes[0] += max(0, size - 1)
            few = sizes <= FEW
            few[0] &= not at_start
            open_one = len(sizes) - 1
            low = np.flatnonzero((lcp >= SHALLOW) & (lcp < DEPTH) & few[region[1:]])
            closed = low[region[low + 1] < open_one]
            found = np.concatenate([np.flatnonzero(lcp >= DEPTH), closed])
            a, b = ids[found], ids[found + 1]
            if open_one and few[0]:
                a, b = np.concatenate([a, waiting[0]]), np.concatenate([b, waiting[1]])
            rest = low[region[low + 1] == open_one]
            held = waiting if not open_one and few[0] else (none, none)
            waiting = (np.concatenate([held[0], ids[rest]]), np.concatenate([held[1], ids[rest + 1]]))
            last, size, at_start = (ids[-1:], keys[-1:]), int(sizes[-1]), at_start and not open_one
            yield told(a, b.tolist(), [None] * len(a), [None] * len(a))
        if last is not None:  # the last region may go on in the next partition, as the first one may in the one before
            part = TaskContext.get().partitionId()
            yield told(np.array([first[0], int(last[0][0])]), [None, None], [first[1], last[1][0].tobytes()], [2 * part, 2 * part + 1])

    ordered = rows.select("id", "key").repartitionByRange("key", "id").sortWithinPartitions("key", "id")
    found = stage(ordered.mapInArrow(run, "a long, b long, edge binary, at long"), "neighbours")
    ends = found.where("edge is not null").select("a", "at", F.substring("edge", 1, _DIGIT.itemsize * (1 + DEPTH)).alias("edge"))  # two rows a partition
    line = Window.orderBy("at")
    across = ends.withColumns({"b": F.lag("a").over(line), "_was": F.lag("edge").over(line)}).where("edge = _was and a <> b").select("a", "b")
    return found.where("edge is null").select("a", "b").union(across)


def _first_blocks(rows: DataFrame, limit: int) -> DataFrame:
    """rows: id, weight, key.  id, place: blocks of neighbours in each order, half of limit in weight."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, weight = TaskContext.get().partitionId(), 0
        for b in batches:
            total = np.cumsum(b.column(1).to_numpy()) + weight
            block = (total - 1) // max(2, limit // 2)
            weight = int(total[-1]) if len(total) else weight
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([f"{part}.{x}" for x in block.tolist()])], ["id", "place"])

    return rows.select("id", "weight", "key").repartitionByRange("key", "id").sortWithinPartitions("key", "id").mapInArrow(run, "id long, place string")


def _open_places(rows: DataFrame, limit: int) -> DataFrame:
    """rows: id, cluster, weight, component, key (of regions; null for the cluster as a whole).  id, place:
    every pair of one region in different components meets in a place of about two limits of weight.

    A region is compared as blocks of all its documents with shares of those outside its largest
    component; a cluster as a whole or region by region, whichever is less."""
    own = rows.groupBy("cluster", "key", "component").agg(F.sum("weight").alias("w"))
    regions = own.groupBy("cluster", "key").agg(F.sum("w").alias("all"), F.max(F.struct("w", "component")).alias("top"))
    regions = regions.select("cluster", "key", "all", (F.col("all") - F.col("top.w")).alias("minor"), F.col("top.component").alias("top")).where("minor > 0")
    work = lambda of: F.sum(F.when(of, F.col("all").cast("double") * F.col("minor")).otherwise(0.0))
    less = regions.groupBy("cluster").agg(work(F.col("key").isNotNull()).alias("apart"), work(F.col("key").isNull()).alias("whole"))
    regions = regions.join(less, "cluster").where(F.col("key").isNull() == (F.col("whole") <= F.col("apart"))).drop("apart", "whole")
    count = lambda c: F.greatest(F.lit(1), F.ceil(F.col(c) / limit)).cast("int")
    rows = rows.join(regions.withColumns({"ni": count("all"), "nj": count("minor")}), (rows["cluster"] == regions["cluster"]) & rows["key"].eqNullSafe(regions["key"])).drop(regions["cluster"]).drop(regions["key"])
    share = F.pmod(F.xxhash64("id", F.lit(1)), F.col("nj")).cast("int")
    block = F.pmod(F.xxhash64("id"), F.col("ni")).cast("int")
    grid = lambda i, j: F.struct(i.alias("i"), j.alias("j"))
    mine = F.transform(F.sequence(F.lit(0), F.col("nj") - 1), lambda j: grid(block, j))
    more = F.when(F.col("component") != F.col("top"), F.transform(F.sequence(F.lit(0), F.col("ni") - 1), lambda i: grid(i, share))).otherwise(F.array().cast("array<struct<i:int,j:int>>"))
    rows = rows.select("id", "cluster", "key", F.explode(F.array_union(mine, more)).alias("p"))
    return rows.select("id", F.concat_ws(".", F.col("cluster"), F.hex("key"), "p.i", "p.j").alias("place"))


def _confirm(rows: DataFrame, percent: int) -> DataFrame:
    """rows: id, d0, d1, text, place.  Links confirmed among the rows of a place, as stars: a, b."""

    def run(table: pa.Table) -> pa.Table:
        ids = table.column("id").to_numpy()
        want = list(zip(table.column("d0").to_pylist(), table.column("d1").to_pylist(), strict=True))
        texts = [x or b"" for x in table.column("text").cast(pa.binary()).to_pylist()]
        sets = [s for start in range(0, len(texts), 64) for s in shingle_sets(texts[start : start + 64])]
        keep = [i for i, s in enumerate(sets) if digest(s) == want[i]]
        a, b = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if len(keep) > 1:
            ids = ids[keep]
            order = np.argsort(ids, kind="stable")
            comp = link([sets[keep[k]] for k in order], percent)
            ids = ids[order]
            first = {}
            for i, c in enumerate(comp.tolist()):
                first.setdefault(c, ids[i])
            a, b = ids, np.array([first[c] for c in comp.tolist()], np.int64)
            a, b = a[a != b], b[a != b]
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return rows.groupBy("place").applyInArrow(run, "a long, b long")


def near_groups(docs: DataFrame, percent: int = 85, limit: int = GROUP, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: the id, n_shingles, component_id (the smallest id reachable by links) and kept.

    Texts with 100 * intersection >= percent * union of their distinct shingles are linked.  Rows with
    the same set are one class from the start, so copies cost no comparisons.  Two texts exactly at the
    threshold share a region in none of the trees with probability 7e-9 (85) or 3e-6 (80) at most, at any
    size of their cluster; limit bounds the weight compared in one task, not which pairs are.

    Null or word-less texts have no shingles and are linked with nothing; rows with a null id are linked
    with nothing and kept; repeated rows share a component, and of those all with the smallest id are
    kept; an empty table gives an empty result; other columns are ignored.
    """
    own = stage(features(docs, id_col, text_col), "features")
    full = own.where("n_shingles > 0 and id is not null")
    classes = full.groupBy("d0", "d1").agg(F.min(F.struct("id", "n_shingles", "signatures")).alias("x"))
    classes = stage(classes.select("d0", "d1", "x.id", "x.signatures", F.ceil(F.col("x.n_shingles") / HEAVY).cast("long").alias("weight")), "classes")
    edges = neighbours(orders(classes.select("id", "signatures"))).distinct()
    clusters = stage(components(edges, "a", "b"), "clusters").select(F.col("node").alias("id"), F.col("component").alias("cluster"))
    member = clusters.join(classes.drop("signatures"), "id")
    member = stage(member.join(member.groupBy("cluster").agg(F.sum("weight").alias("n")), "cluster"), "members")
    text = sieve(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")), member, "id")
    rows = text.join(member.select("id", "d0", "d1", "cluster", "n"), "id")
    links = stage(_confirm(rows.where(F.col("n") <= limit).withColumn("place", F.col("cluster").cast("string")), percent), "links")
    if not member.where(F.col("n") > limit).isEmpty():
        large = stage(member.where(F.col("n") > limit).join(classes.select("id", "signatures"), "id").select("id", "cluster", "weight", "signatures"), "large")
        rows = stage(rows.where(F.col("n") > limit).select("id", "d0", "d1", "text"), "large_texts")
        near = components(_confirm(rows.join(_first_blocks(orders(large, FIRST), limit), "id"), percent))
        near = stage(near.select(F.col("node").alias("id"), "component"), "near")
        known = large.join(near, "id", "left").withColumn("component", F.coalesce("component", "id"))
        regions = orders(known).withColumn("key", F.substring("key", 1, _DIGIT.itemsize * (1 + DEPTH)))
        known = regions.unionByName(known.drop("signatures").withColumn("key", F.lit(None).cast("binary")))
        rest = _confirm(rows.join(_open_places(stage(known, "regions"), limit), "id"), percent)
        both = components(rest.union(near.select("id", "component")))
        links = links.union(both.where("node <> component").select(F.col("node").alias("a"), F.col("component").alias("b")))
    class_of = classes.join(links.select(F.col("a").alias("id"), "b"), "id", "left").select("d0", "d1", F.coalesce("b", "id").alias("_c"))
    out = own.drop("signatures").join(class_of, ["d0", "d1"], "left")
    component = F.when((F.col("n_shingles") > 0) & F.col("id").isNotNull(), F.col("_c")).otherwise(F.col("id"))
    return out.select(F.col("id").alias(id_col), "n_shingles", component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))


def drop_near(docs: DataFrame, percent: int = 80, limit: int = GROUP, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs without the rows whose ids near_groups() keeps nowhere; all columns stay."""
    judged = near_groups(docs, percent, limit, id_col, text_col)
    gone = judged.groupBy(id_col).agg(F.max("kept").alias("_kept")).where("not _kept").select(F.col(id_col).alias("_gone"))
    return docs.join(gone, docs[id_col].cast("long") == gone["_gone"], "left_anti")
