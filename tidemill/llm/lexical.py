"""Ranked lexical search: document shards of postings with integer impacts, scored term by term."""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import ranked, shared_dir, stage
from .words import chunks, lower_bytes, per_doc

#: Texts of a shard, in bytes; a longer text is a shard of its own.
SHARD = 2 << 20
#: Pairs of item and term that one pass over the shards scores; an item's pairs stay together.
BLOCK = 1 << 18
#: Row groups of shards, in bytes: what a reader holds at once.
GROUP_BYTES = 32 << 20

#: Bytes of terms: digits, ASCII letters, and all of non-ASCII characters.
TERM = np.zeros(256, bool)
TERM[48:58] = TERM[65:91] = TERM[97:123] = TERM[128:] = True


def term_array(texts: list[bytes]) -> tuple[pa.Array, np.ndarray]:
    """The terms of texts in order, A-Z lower-cased, and how many each text has."""
    buf = lower_bytes(np.frombuffer(b"\n".join([*texts, b""]), np.uint8))
    inside = TERM[buf]
    edge = np.diff(np.concatenate([[0], inside.view(np.int8), [0]]).astype(np.int8))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
    begins = np.concatenate([[0], np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)])
    terms = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(buf[inside])])
    return terms, np.diff(np.searchsorted(starts, begins))


def _packed(terms: pa.Array) -> tuple[bytes, bytes]:
    """A term array as its bytes and its ends."""
    sizes = pc.binary_length(terms).to_numpy(zero_copy_only=False)
    return b"".join(terms.to_pylist()), np.cumsum(sizes).astype("<i8").tobytes()


def _unpacked(data: bytes, ends: bytes) -> pa.Array:
    offsets = np.concatenate([[0], np.frombuffer(ends, "<i8")]).astype(np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(data)])


@dataclass(frozen=True)
class Index:
    """shards: doc_ids, term_data, term_ends, starts, places, impacts; one row a shard.  documents: how
    many hold a term; terms: their terms with repeats."""

    shards: DataFrame
    documents: int
    terms: int


def norms(sizes: np.ndarray, documents: int, terms: int) -> np.ndarray:
    """m = 100 - 90 + (90 n N) div L of each document, in Python's integers, as n N may leave 64 bits."""
    return np.array([10 + 90 * int(n) * documents // terms for n in sizes], np.int64)


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shard_bytes: int = SHARD) -> Index:
    """Indexes every row of docs: one pass counts documents and terms, a second builds the shards, each by
    one task from neighbouring rows, and writes them to the shared folder.

    In a shard, documents have places in ascending order of their ids (nulls last), and the postings of a
    term are the stretch starts[t]:starts[t + 1] of places and impacts (compressed sparse rows).  Terms are
    compared as bytes, not as hashes.  Null, empty and term-less texts hold no term and count nowhere;
    repeated rows are documents of their own; other columns are ignored."""
    spark, rows = docs.sparkSession, docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        documents = terms = 0
        for texts, _ in chunks(batches, 0):
            buf = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
            inside = TERM[buf]
            first = inside & ~np.concatenate([[False], inside[:-1]])
            own = per_doc(first, np.concatenate([[0], np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)]))
            documents, terms = documents + int((own > 0).sum()), terms + int(own.sum())
        yield pa.RecordBatch.from_pydict({"n": [documents], "l": [terms]})

    n, l = rows.select("text").mapInArrow(count, "n long, l long").agg(F.sum("n"), F.sum("l")).first()  # noqa: E741
    n, l = n or 0, l or 0  # noqa: E741

    def build(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for texts, part in chunks(batches, 1, shard_bytes):
            order = pc.sort_indices(part.column(0), null_placement="at_end").to_numpy()
            terms, sizes = term_array([texts[i] for i in order])
            has = sizes > 0
            if not has.any():
                continue
            doc = np.repeat(np.cumsum(has) - 1, sizes)
            coded = terms.dictionary_encode()
            docs = int(has.sum())
            pair, tf = np.unique(coded.indices.to_numpy().astype(np.int64) * docs + doc, return_counts=True)
            term, place = pair // docs, pair % docs
            data, ends = _packed(coded.dictionary)
            impacts = ((1_000_000_000 * tf) // (1000 * tf + 8 * norms(sizes[has], n, l)[place])).astype("<i4")
            starts = np.searchsorted(term, np.arange(len(coded.dictionary) + 1)).astype("<i8")
            ids = part.column(0).take(pa.array(order[has]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([ids.to_pylist()], pa.list_(ids.type)), *(pa.array([x], pa.binary()) for x in (data, ends, starts.tobytes(), place.astype("<i4").tobytes(), impacts.tobytes()))],
                ["doc_ids", "term_data", "term_ends", "starts", "places", "impacts"],
            )

    id_type = rows.schema["id"].dataType.simpleString()
    shards = rows.mapInArrow(build, f"doc_ids array<{id_type}>, term_data binary, term_ends binary, starts binary, places binary, impacts binary")
    path = f"{shared_dir(spark)}/postings-{uuid.uuid4().hex}"
    # rows are megabytes long, so sizes are looked at after every row
    sizes = {"parquet.block.size": GROUP_BYTES, "parquet.page.size.row.check.min": 1, "parquet.page.size.row.check.max": 1, "parquet.block.size.row.check.min": 1, "parquet.block.size.row.check.max": 1}
    shards.write.options(**sizes).parquet(path)
    return Index(spark.read.schema(shards.schema).parquet(path), n, l)


def weight(df: int, documents: int) -> int:
    """floor(1000 ln((2N + 2) / (2 df + 1)))."""
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


def _frequencies(shards: DataFrame, wanted: pa.Array) -> np.ndarray:
    """How many documents hold each wanted term."""

    def look(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(wanted), np.int64)
        for b in batches:
            for r in range(b.num_rows):
                terms = _unpacked(b.column(0)[r].as_py(), b.column(1)[r].as_py())
                sizes = np.diff(np.frombuffer(b.column(2)[r].as_py(), "<i8"))
                at = pc.fill_null(pc.index_in(wanted, value_set=terms), -1).to_numpy()
                total[at >= 0] += sizes[at[at >= 0]]
        k = np.flatnonzero(total)
        if len(k):
            yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(total[k])], ["term", "df"])

    out = np.zeros(len(wanted), np.int64)
    found = shards.select("term_data", "term_ends", "starts").mapInArrow(look, "term long, df long")
    for k, df in found.groupBy("term").agg(F.sum("df")).collect():  # the block's terms at most
        out[k] = df
    return out


def best(scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores above 0; of equal ones the lower places."""
    some = np.flatnonzero(scores > 0)
    if len(some) <= k:
        return some
    own = scores[some]
    least = own[np.argpartition(own, -k)[-k:]].min()
    above = some[own > least]
    return np.concatenate([above, some[own == least][: k - len(above)]])


def _scorer(items: np.ndarray, terms: np.ndarray, weights: np.ndarray, wanted: pa.Array, ids: pa.Array, k: int):
    """A map over shards to the task's k best documents of each item.  items and terms are the pairs of
    the block, by item."""
    first = np.flatnonzero(np.diff(items, prepend=-1))
    bounds = np.append(first, len(items))

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for b in batches:
            for r in range(b.num_rows):
                own = {n: b.column(n)[r].as_py() for n in ("term_data", "term_ends", "starts", "places", "impacts")}
                at = pc.fill_null(pc.index_in(wanted, value_set=_unpacked(own["term_data"], own["term_ends"])), -1).to_numpy()
                starts, places, impacts = (np.frombuffer(own[n], t) for n, t in (("starts", "<i8"), ("places", "<i4"), ("impacts", "<i4")))
                docs = b.column("doc_ids")[r].values
                hits = []
                for i, j in zip(bounds[:-1], bounds[1:], strict=True):
                    found = terms[i:j][at[terms[i:j]] >= 0]
                    if not len(found):
                        continue
                    total = np.zeros(len(docs), np.int64)
                    for t in found:
                        own_rows = slice(starts[at[t]], starts[at[t] + 1])
                        total[places[own_rows]] += weights[t] * impacts[own_rows].astype(np.int64)
                    top = best(total, k)
                    hits.append((np.full(len(top), items[i]), total[top], top))
                if not hits:
                    continue
                item, points, place = (np.concatenate(x) for x in zip(*hits, strict=True))
                new = pa.table({"item": item, "score": points, "doc_id": docs.take(pa.array(place))})
                held = pa.concat_tables([held, new]) if held is not None else new
                held = held.sort_by([("item", "ascending"), ("score", "descending"), ("doc_id", "ascending")])
                item = held["item"].to_numpy()
                rank = np.arange(len(item)) - np.searchsorted(item, item)
                held = held.filter(pa.array(rank < k))
        if held is not None and held.num_rows:
            held = held.combine_chunks()
            yield pa.RecordBatch.from_arrays([ids.take(held["item"].chunk(0)), held["doc_id"].chunk(0), held["score"].chunk(0)], ["item_id", "doc_id", "score"])

    return score


def search(index: Index, items: DataFrame, k: int = 10, item_col: str = "item_id", text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """item_id, rank, doc_id, score: each item's k best documents with a score above 0, ties by ascending
    id (null ids last).

    Items go in blocks of about `block` pairs of item and term; a block passes over all shards twice: once
    for the document frequencies of its terms, once to score.  Within a task the best documents of all its
    shards are merged, so the last ranking sees k rows of each task for an item.

    Rows with equal item ids (nulls together) are one item with the terms of all; items without terms have
    no rows; an empty index or item table gives no rows.  Repeated documents take ranks of their own."""
    spark = items.sparkSession

    def split(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for texts, part in chunks(batches, 1):
            terms, sizes = term_array(texts)
            yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(np.repeat(np.arange(len(texts)), sizes))), terms.cast(pa.binary())], ["item", "term"])

    item_type = items.schema[item_col].dataType.simpleString()
    pairs = items.select(item_col, text_col).mapInArrow(split, f"item {item_type}, term binary").distinct()
    pairs = stage(ranked(pairs, [F.col("item"), F.col("term")], "pairs", "_rank"), "pairs")
    n = pairs.count()
    starts = pairs.groupBy(F.col("item").alias("_item")).agg(F.floor(F.min("_rank") / block).alias("_block"))
    pairs = stage(pairs.join(starts, F.col("item").eqNullSafe(F.col("_item"))).select("item", "term", "_block", "_rank"), "blocks") if n > block else pairs.withColumn("_block", F.lit(0))
    schema = f"item_id {item_type}, doc_id {index.shards.schema['doc_ids'].dataType.elementType.simpleString()}, score long"
    found = None
    for b in range(-(-n // block)) if index.documents else ():
        rows = pairs.where(F.col("_block") == b).orderBy("_rank").select("item", "term").toArrow()
        if not rows.num_rows:
            continue
        ids, wanted = (rows[c].combine_chunks().dictionary_encode("encode") for c in ("item", "term"))
        terms = wanted.dictionary.cast(pa.large_binary())
        frequencies = _frequencies(index.shards, terms)
        weights = np.array([weight(int(df), index.documents) for df in frequencies], np.int64)
        run = _scorer(ids.indices.to_numpy().astype(np.int64), wanted.indices.to_numpy().astype(np.int64), weights, terms, ids.dictionary, k)
        hits = index.shards.mapInArrow(run, schema)
        found = hits if found is None else found.unionByName(hits)
    found = spark.createDataFrame([], schema) if found is None else found
    own = Window.partitionBy("item_id").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(own)).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
