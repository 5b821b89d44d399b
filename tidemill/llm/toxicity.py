"""Toxicity by a chain of linear models."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StructField, StructType

from .shared import smallest_hashes

#: Labelled documents that the chain is fitted on, at most: those with the smallest hashes.
FIT_ROWS = 8_000
#: Words and word beginnings that the linear models see, at most; and at most one for so many documents
#: of the fit, for with more of them few labels are learned by heart.
FEATURES, ROWS_A_FEATURE = 800, 8
#: A feature is considered from so many labelled documents on.
LEAST = 3
STEM = 5
FOLDS = 3
THRESHOLD = 0.5

_WORD = re.compile(r"\w+")


def terms(text: str) -> np.ndarray:
    """Sorted hashes of the distinct lower-cased words, and of the beginnings of longer ones, of a whole text."""
    words = set(_WORD.findall(text.lower()))
    words |= {w[:STEM] + "-" for w in words if len(w) > STEM}
    return np.sort(np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)))


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


class Sparse:
    """Rows of feature numbers with value 1: parallel arrays rows and cols, and n rows in all."""

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.rows, w[self.cols], self.n)

    def back(self, r: np.ndarray, size: int) -> np.ndarray:
        return np.bincount(self.cols, r[self.rows], size)

    def take(self, mask: np.ndarray) -> Sparse:
        out, on = object.__new__(Sparse), mask[self.rows]
        out.n, out.cols, out.rows = int(mask.sum()), self.cols[on], (np.cumsum(mask) - 1)[self.rows[on]]
        return out


def fit_linear(x: Sparse, extra: np.ndarray, y: np.ndarray, size: int, steps: int = 150, l2: float = 1e-3) -> np.ndarray:
    """Logistic regression by Adam over whole passes, both classes weighing the same.  The weights are
    size word weights, one for each column of extra, and the constant."""
    k = extra.shape[1]
    w, m, v = (np.zeros(size + k + 1) for _ in range(3))
    each = np.where(y > 0, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1))
    for t in range(1, steps + 1):
        r = each * (_sigmoid(x.dot(w[:size]) + extra @ w[size:-1] + w[-1]) - y)
        g = np.concatenate([x.back(r, size), extra.T @ r, [r.sum()]])
        g[:-1] += l2 * w[:-1]
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w -= 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    return w


def _features(seen: np.ndarray, rows: list[np.ndarray]) -> Sparse:
    """Each row's terms that the model knows, as places in seen (sorted)."""
    flat = np.concatenate([*rows, np.zeros(0, np.uint64)])
    at = np.searchsorted(seen, flat)
    on = seen[np.minimum(at, len(seen) - 1)] == flat if len(seen) else np.zeros(len(flat), bool)
    out = object.__new__(Sparse)
    out.n, out.cols = len(rows), at[on]
    out.rows = np.repeat(np.arange(len(rows)), np.fromiter(map(len, rows), np.int64, len(rows)))[on]
    return out


def fit_chain(rows: list[np.ndarray], labels: np.ndarray, folds: int = FOLDS) -> dict:
    """labels: a 0/1 column for each category, in chain order.  Each model sees the words and the earlier
    categories' probabilities; in training those come from models that did not see the document."""
    known, number = np.unique(np.concatenate([*rows, np.zeros(0, np.uint64)]), return_inverse=True)
    owner = np.repeat(np.arange(len(rows)), np.fromiter(map(len, rows), np.int64, len(rows)))
    count, chosen = np.bincount(number, minlength=len(known)), np.zeros(len(known), bool)
    for j in range(labels.shape[1]):
        p = labels[:, j].mean() if len(rows) else 0.0
        if 0 < p < 1:
            hits = np.bincount(number, labels[owner, j], len(known))
            pull = np.where(count >= LEAST, np.abs(hits - count * p) / np.sqrt(np.maximum(count, 1) * p * (1 - p)), -1.0)
            best = np.argsort(-pull, kind="stable")[: min(FEATURES, max(40, len(rows) // ROWS_A_FEATURE)) // labels.shape[1]]
            chosen[best[pull[best] >= 0]] = True
    seen = known[chosen]
    x = _features(seen, rows)
    fold = np.arange(len(rows)) % folds
    extra, models = np.zeros((len(rows), 0)), []
    for j in range(labels.shape[1]):
        y = labels[:, j].astype(float)
        models.append(fit_linear(x, extra, y, len(seen)))
        if j + 1 < labels.shape[1]:
            out = np.zeros(len(rows))
            for f in range(folds):
                w = fit_linear(x.take(fold != f), extra[fold != f], y[fold != f], len(seen))
                part = x.take(fold == f)
                out[fold == f] = _sigmoid(part.dot(w[: len(seen)]) + extra[fold == f] @ w[len(seen) : -1] + w[-1])
            extra = np.column_stack([extra, out])
    return {"seen": seen, "models": models}


def chain_scores(model: dict, rows: list[np.ndarray]) -> np.ndarray:
    """Probabilities of each category, in chain order."""
    size, x = len(model["seen"]), _features(model["seen"], rows)
    out = np.zeros((len(rows), 0))
    for w in model["models"]:
        out = np.column_stack([out, _sigmoid(x.dot(w[:size]) + out @ w[size:-1] + w[-1])])
    return out


def fit_toxicity(docs: DataFrame, labels: DataFrame, categories: tuple[str, ...], fit_rows: int = FIT_ROWS, id_col: str = "doc_id", text_col: str = "text") -> dict:
    """Fits the chain on at most fit_rows labelled documents.  Tasks turn whole texts into terms and return
    hashes of the distinct ones; labels of several rows for one id count once, the largest."""
    picked = labels.where(F.col(id_col).isNotNull()).groupBy(id_col).agg(*(F.max(F.coalesce(F.col(c).cast("int"), F.lit(0))).alias(c) for c in categories))
    picked = smallest_hashes(picked, fit_rows, id_col)
    rows = docs.select(id_col, F.coalesce(F.col(text_col), F.lit("")).alias("_text")).join(F.broadcast(picked), id_col)

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [terms(x).tobytes() for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, pa.binary()), *(b.column(i + 2) for i in range(len(categories)))], ["id", "terms", *categories])

    id_type = docs.schema[id_col].dataType.simpleString()
    got = rows.mapInArrow(read, ", ".join([f"id {id_type}", "terms binary", *(f"{c} int" for c in categories)]))
    got = sorted((tuple(r) for r in got.toLocalIterator()), key=lambda r: (r[0], bytes(r[1])))
    return fit_chain([np.frombuffer(r[1], np.uint64) for r in got], np.array([r[2:] for r in got], np.int64).reshape(len(got), len(categories)))


def score_toxicity(docs: DataFrame, model: dict, categories: tuple[str, ...], threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """All rows of docs with p_<category> for each category and toxic: the last category's probability
    reaches the threshold."""
    added = [*(f"p_{c}" for c in categories), "toxic"]
    rows = docs.select(*[c for c in docs.columns if c not in added])
    at, names, count = rows.columns.index(text_col), [*rows.columns, *added], len(categories)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def judge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 256):
                b = whole.slice(start, 256)
                p = np.round(chain_scores(shared.value, [terms(x or "") for x in b.column(at).to_pylist()]), 9)
                yield pa.RecordBatch.from_arrays([*b.columns, *(pa.array(p[:, j]) for j in range(count)), pa.array(p[:, -1] >= threshold)], names)

    new = [StructField(c, BooleanType() if c == "toxic" else DoubleType()) for c in added]
    return rows.mapInArrow(judge, StructType([*rows.schema.fields, *new]))


def toxicity(docs: DataFrame, labels: DataFrame, categories: tuple[str, ...] = ("poor", "toxic"), fit_rows: int = FIT_ROWS, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Judges every whole document by a classifier chain: logistic regressions over words and word
    beginnings, each fed the earlier categories' probabilities, fitted with out-of-fold ones.

    labels has the id and a 0/1 column for each category, in chain order; the last decides.  Null text
    is empty; null labels count as 0; without labels of both kinds every probability is 0.5 or the
    constant's, and a chain that learned nothing marks nothing (see below); null ids are never used in
    the fit; repeated rows are judged alike; columns named like the added ones are replaced.
    """
    model = fit_toxicity(docs, labels, categories, fit_rows, id_col, text_col)
    if not len(model["seen"]):  # nothing to tell the classes apart by
        return score_toxicity(docs, model, categories, 2.0, text_col)
    return score_toxicity(docs, model, categories, threshold, text_col)


def drop_toxic(docs: DataFrame, labels: DataFrame, categories: tuple[str, ...] = ("poor", "toxic"), id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of docs that toxicity() does not mark, with all their columns whatever their names."""
    names = [f"_c{i}" for i in range(len(docs.columns))]
    of = dict(zip(docs.columns, names, strict=True))
    judged = toxicity(docs.toDF(*names), labels.withColumnRenamed(id_col, of[id_col]), categories, id_col=of[id_col], text_col=of[text_col], **options)
    return judged.where(~F.col("toxic")).select(*names).toDF(*docs.columns)


def with_poor(labels: DataFrame) -> DataFrame:
    """The label table's two categories in chain order: poor (quality 0), then toxic."""
    return labels.select("doc_id", (F.col("quality") == 0).cast("int").alias("poor"), "toxic")
