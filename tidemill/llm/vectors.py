"""Vector code compression: product codes by integer k-means, assigned by exponion search."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import discard, shared_dir

PARTS, ENTRIES, ROUNDS = 8, 16, 6
#: Components become integers in steps of 1 / SCALE.
SCALE = 4096
#: Labels whose error sums are broadcast, at most; with more labels the sums are joined by a shuffle.
FEW_LABELS = 100_000


def integers(vector: Column, parts: int = PARTS) -> Column:
    """floor(SCALE * x) of each component.  Magnitudes end where four squared distances between parts still
    fit 64 bits: at 2^27.5 for parts of 8 components, which is 46,000 before scaling."""
    most = F.floor(F.sqrt(F.lit(float(2**60)) / (F.size(vector) / parts)) / 2)
    return F.transform(vector, lambda x: F.floor(F.greatest(F.least(x * SCALE, most), -most)).cast("int"))


def nearest(x: np.ndarray, entries: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """The nearest entry of each row (ties to the lower index), its squared distance, and how many
    distances between rows and entries were computed.

    Exponion search: with u the distance to the entry at which a row starts, an entry as near as that lies
    within 2u of it.  Entries are sorted by distance from each entry once, so a row scans the head of one
    list.  All in integers: squared distances are compared with 4u^2."""
    between = ((entries[:, None] - entries[None]) ** 2).sum(2)
    order = np.argsort(between, axis=1, kind="stable")
    reach = np.take_along_axis(between, order, 1)
    code, best = start.copy(), ((x - entries[start]) ** 2).sum(1)
    within = (reach[start] <= 4 * best[:, None]).sum(1)
    computed = len(x)
    for k in range(len(entries)):
        rows = np.flatnonzero(within > k)
        if not len(rows):
            break
        other = order[start[rows], k]
        rows, other = rows[other != start[rows]], other[other != start[rows]]
        far = ((x[rows] - entries[other]) ** 2).sum(1)
        computed += len(rows)
        closer = (far < best[rows]) | ((far == best[rows]) & (other < code[rows]))
        best[rows[closer]], code[rows[closer]] = far[closer], other[closer]
    return code, best, computed


def _assigner(books: np.ndarray, last: bool):
    """A map over staged rows that starts at their codes and assigns every part anew.  Rows have kind 0;
    rows of kind 1 have what a task's parts of one entry sum up to (not on the last pass)."""
    parts, entries, width = books.shape
    added = [("error", pa.int64()), ("slot", pa.int32()), ("n", pa.int64()), ("sums", pa.list_(pa.int64())), ("kind", pa.int32())]

    def batch(columns: dict, rows: int, schema: pa.Schema) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([columns.get(f.name, pa.nulls(rows, f.type)) for f in schema], schema=schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums, schema = np.zeros((parts, entries), np.int64), np.zeros((parts, entries, width), np.int64), None
        for b in batches:
            schema, n = pa.schema([*b.schema, *map(pa.field, *zip(*added, strict=True))]), b.num_rows
            x = b.column("x").flatten().to_numpy().astype(np.int64).reshape(n, parts, width)
            before = np.frombuffer(b"".join(b.column("code").to_pylist()), np.uint8).reshape(n, parts)
            codes, error = np.empty((n, parts), np.uint8), np.zeros(n, np.int64)
            for p in range(parts):
                own, far, _ = nearest(x[:, p], books[p], before[:, p].astype(np.int64))
                codes[:, p], error = own, error + far
                counts[p] += np.bincount(own, minlength=entries)
                np.add.at(sums[p], own, x[:, p])
            full = {"id": b.column("id"), "label": b.column("label"), "code": pa.array([c.tobytes() for c in codes], pa.binary()), "error": pa.array(error), "kind": pa.array(np.zeros(n, np.int32))}
            yield batch(full if last else full | {"x": b.column("x")}, n, schema)
        slot = np.flatnonzero(counts.ravel())
        if not last and len(slot):
            own = pa.array(list(sums.reshape(-1, width)[slot]), pa.list_(pa.int64()))
            yield batch({"slot": pa.array(slot.astype(np.int32)), "n": pa.array(counts.ravel()[slot]), "sums": own, "kind": pa.array(np.ones(len(slot), np.int32))}, len(slot), schema)

    return run


def compress(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """Codes of every vector, (id, label, code binary: one index a part, error long), and the codebooks,
    integers of shape (parts, entries, width).  entries is 256 at most.

    Each round is one pass without a shuffle of vectors: tasks start at the codes of the round before,
    which lie beside the vectors, assign every part by nearest(), write the new codes, and sum up the parts
    of each entry; the sums (parts x entries rows a task) make the next codebooks.  The tables of the round
    before are deleted once the next ones are written.

    Rows go whose vector is null, has a null or non-finite component, or has no components.  All vectors
    have as many components as the one with the smallest id has, a multiple of parts; others go.  Equal ids
    are ordered by their vectors, null ids come last.  Fewer vectors than entries make fewer entries;
    without vectors the codebooks are empty.  Other columns are ignored.  See integers() for magnitudes."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vector_col).cast("array<double>").alias("x"))
    rows = rows.where((F.size("x") > 0) & (F.size("x") % parts == 0) & ~F.exists("x", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))))
    base = f"{shared_dir(spark)}/vectors-{uuid.uuid4().hex}"
    rows.select("id", "label", integers(F.col("x"), parts).alias("x")).write.parquet(f"{base}/ints")
    rows = spark.read.parquet(f"{base}/ints")
    order = [F.col("id").asc_nulls_last(), F.col("x")]
    first = rows.orderBy(*order).limit(1).collect()
    if not first:
        return rows.select("id", "label", F.lit(b"").alias("code"), F.lit(0).cast("long").alias("error")), np.zeros((parts, 0, 0), np.int64)
    rows = rows.where(F.size("x") == len(first[0].x))
    seeds = np.array([r.x for r in rows.orderBy(*order).limit(entries).collect()], np.int64)
    books = seeds.reshape(len(seeds), parts, -1).transpose(1, 0, 2).copy()
    types = {f.name: f.dataType.simpleString() for f in rows.schema}
    schema = f"id {types['id']}, label {types['label']}, x array<int>, code binary, error long, slot int, n long, sums array<long>, kind int"
    rows, held = rows.withColumn("code", F.lit(bytes(parts))), f"{base}/ints"
    for k in range(rounds):
        path = f"{base}/{k}"
        rows.select("id", "label", "x", "code").mapInArrow(_assigner(books, False), schema).write.parquet(path)  # unsorted: rows of kind 1 are few
        discard(spark, held)
        made = spark.read.schema(schema).parquet(path)
        width = books.shape[2]
        sums = made.where("kind = 1").groupBy("slot").agg(F.sum("n").alias("n"), *(F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(width)))
        flat = books.reshape(-1, width)
        for slot, n, *own in sums.collect():  # parts x entries rows at most
            flat[slot] = [s // n for s in own]
        rows, held = made.where("kind = 0"), path
    last = rows.select("id", "label", "x", "code").mapInArrow(_assigner(books, True), schema).select("id", "label", "code", "error")
    last.write.parquet(f"{base}/codes")
    discard(spark, held)
    return spark.read.schema(last.schema).parquet(f"{base}/codes"), books


def decode(codes: DataFrame, books: np.ndarray, code_col: str = "code") -> DataFrame:
    """Adds vector array<double>: the entries that a code names, joined and scaled back."""
    tables = F.array(*(F.array(*(F.array(*(F.lit(float(v) / SCALE) for v in e)) for e in part)) for part in books))
    at = lambda p: F.conv(F.substring(F.hex(code_col), 2 * p + 1, 2), 16, 10).cast("int")
    return codes.withColumn("vector", F.flatten(F.array(*(tables[p][at(p)] for p in range(len(books))))))


def books_digest(books: np.ndarray) -> str:
    """SHA-256 of all entries' decimal components by part, entry and place, joined by commas."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def with_label_errors(codes: DataFrame) -> DataFrame:
    """Adds label_error: the errors of equal labels summed, nulls together; null where the sum leaves 64 bits."""
    sums = codes.groupBy(F.col("label").alias("_label")).agg(F.try_sum("error").alias("label_error"))
    few = sums.limit(FEW_LABELS + 1).count() <= FEW_LABELS
    return codes.join(F.broadcast(sums) if few else sums, F.col("label").eqNullSafe(F.col("_label")), "left").drop("_label")
