"""Quality rules: counts that any text must meet, then a hashed n-gram log-likelihood ratio."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import smallest_hashes
from .words import U, Words, chunks, per_doc

#: Hash buckets of each n-gram order, as a power of two; orders are 1 and 2.
BITS = 16
#: Labelled trusted documents that the target multinomial is fitted on, at most: the smallest hashes.
FIT_ROWS = 20_000
#: Mean log ratio per n-gram below which a document goes.
THRESHOLD = -0.17
#: How many trusted n-grams at the corpus's rate every bucket has beforehand: a bucket that is rare in
#: the corpus says little by its absence from the trusted text.
PRIOR = 5.0
SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True


def _grams(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Texts and bucket numbers of all 1-grams, then all 2-grams."""
    at, pairs = words.windows(2)
    shift = U(64 - BITS)
    return np.concatenate([words.doc, words.doc[at]]), np.concatenate([words.hash >> shift, (pairs >> shift) + U(1 << BITS)]).astype(np.int64)


def ngram_counts(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """bucket, raw, target: n-gram counts over all docs, and over those whose ids trusted holds.
    trusted has at most FIT_ROWS ids."""
    flag = trusted.select(F.col(id_col), F.lit(True).alias("_trusted"))
    rows = docs.select(id_col, F.col(text_col).alias("_text")).join(F.broadcast(flag), id_col, "left").select("_text", F.coalesce("_trusted", F.lit(False)).alias("_t"))

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target = np.zeros(2 << BITS, np.int64), np.zeros(2 << BITS, np.int64)
        for texts, part in chunks(batches, 0):
            good = part.column(1).to_numpy(zero_copy_only=False).astype(bool)
            doc, bucket = _grams(Words(texts))
            raw += np.bincount(bucket, minlength=2 << BITS)
            target += np.bincount(bucket[good[doc]], minlength=2 << BITS)
        k = np.flatnonzero(raw)
        if len(k):
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (k, raw[k], target[k])], ["bucket", "raw", "target"])

    return rows.mapInArrow(count, "bucket long, raw long, target long").groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))


def log_ratios(counts: DataFrame) -> np.ndarray:
    """Log ratio of the trusted to the corpus multinomial for each bucket, drawn towards 0 by PRIOR; zeros
    without trusted text.  The table has 2^(BITS + 1) rows at most."""
    raw, target = np.zeros(2 << BITS), np.zeros(2 << BITS)
    for k, r, t in counts.collect():
        raw[k], target[k] = r, t
    out = np.zeros(2 << BITS)
    for half in (slice(0, 1 << BITS), slice(1 << BITS, None)):
        a, b = target[half], raw[half]
        if a.sum():
            out[half] = np.log((a + PRIOR) / (b * (a.sum() / b.sum()) + PRIOR))
    return out


def _counts(words: Words, texts: list[bytes]) -> list[np.ndarray]:
    n = np.diff(words.first)
    chars = per_doc(~words.space & ((words.buf & 0xC0) != 0x80), words.begins)
    symbols = per_doc(SYMBOLS[words.buf], words.begins)
    lines = np.zeros(len(texts), np.int64)
    for i, x in enumerate(texts):
        own = [y for y in x.split(b"\n") if y and not y.isspace()]
        lines[i] = len(own) - len(set(own))
    at, h = words.windows(5)
    h = h ^ (words.doc[at].astype(U) * U(0x9E3779B97F4A7C15))
    order = np.argsort(h)
    same = h[order][1:] == h[order][:-1]
    again = np.zeros(len(h), bool)
    again[order[1:]] |= same
    again[order[:-1]] |= same
    covered = np.zeros(len(words.hash) + 5, np.int64)
    np.add.at(covered, at[again], 1)
    np.add.at(covered, at[again] + 5, -1)
    repeats = per_doc(np.cumsum(covered[: len(words.hash)]) > 0, words.first)
    return [n, chars, symbols, lines, repeats]


def quality_rows(docs: DataFrame, ratios: np.ndarray, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: the id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    llr (mean log ratio per n-gram, 0 without words), base_failed and kept."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def judge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for texts, part in chunks(batches, 1):
            words = Words(texts)
            n, *rest = _counts(words, texts)
            doc, bucket = _grams(words)
            total = np.bincount(doc, minlength=len(texts))
            llr = np.round(np.bincount(doc, ratios[bucket], len(texts)) / np.maximum(total, 1), 9)
            failed = (n < 10) | (100 * rest[3] > 20 * n)
            columns = [part.column(0), *(pa.array(x, pa.int64()) for x in (n, *rest)), pa.array(llr), pa.array(failed), pa.array(~failed & (llr >= threshold))]
            yield pa.RecordBatch.from_arrays(columns, ["id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "llr", "base_failed", "kept"])

    schema = f"id {id_type}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, llr double, base_failed boolean, kept boolean"
    return docs.select(id_col, text_col).mapInArrow(judge, schema).withColumnRenamed("id", id_col)


def quality_rules(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Judges every document by base counts and by how much likelier its words and word pairs are under
    the trusted texts' multinomial than under the whole corpus's.

    The corpus side counts every n-gram of every document; the trusted side is a bounded fit on at most
    fit_rows labelled documents with quality 1.  The ratio is the mean over the text's n-grams, and one
    threshold decides all documents, so reruns agree.

    Null text is empty and fails the base; null ids are rows like any other and never trusted; without
    trusted text every ratio is 0; repeated rows are judged alike; other columns are ignored.
    """
    ids = labels.where((F.col("quality") == 1) & F.col(id_col).isNotNull()).select(id_col).distinct()
    ids = smallest_hashes(ids, fit_rows, id_col)
    return quality_rows(docs, log_ratios(ngram_counts(docs, ids, id_col, text_col)), threshold, id_col, text_col)
