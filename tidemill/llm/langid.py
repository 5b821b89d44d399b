"""Language identification: words by their log frequency in each language, shorter and shorter character
n-grams for unseen words."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import stage
from .words import U, chunks, mix, per_doc

#: Length of character n-grams, tried in this order; 0 stands for whole words.
ORDERS = (0, 5, 4, 3, 2, 1)
#: Words and n-grams of a language stay in the model from this share of all of its order on, times the
#: number of languages: so every order has 1 / SHARE entries at most, however much text is counted.
SHARE = 4e-6
#: Scores are integers in steps of 1 / STEP, so that sums don't depend on their order.
STEP = 1 << 16
#: Texts looked at together, in bytes.
PIECE = 4 << 20


def held_out(doc_id: Column) -> Column:
    """True for ids with crc32(id as text) mod 4 = 2; a null id counts as empty text, which is not held out."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 4 == 2


def has_letter(text: Column) -> Column:
    """Whether the text has a letter of any script; false for null."""
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def word_array(texts: list[bytes]) -> tuple[pa.Array, np.ndarray]:
    """The words of texts, in lower case, and how many each text has.  A word is a run of ASCII letters
    and other characters but Latin-1 signs, general and CJK punctuation, and emoji."""
    joined = pc.utf8_lower(pa.array(texts, pa.large_binary()).cast(pa.large_string()))
    sizes = pc.binary_length(joined).to_numpy(zero_copy_only=False)
    buf = np.frombuffer(b"\n".join([*joined.cast(pa.large_binary()).to_pylist(), b"", b"\n\n"]), np.uint8)
    inside = ((buf >= 97) & (buf <= 122)) | (buf >= 128)
    second = np.append(buf[1:], 0)
    signs = (buf == 0xC2) & ~np.isin(second, (0xAA, 0xB5, 0xBA)) | (buf == 0xC3) & np.isin(second, (0x97, 0xB7))
    for lead, size in ((signs, 2), ((buf == 0xE2) & (second <= 0x81) | (buf == 0xE3) & (second == 0x80), 3), ((buf == 0xF0) & (second == 0x9F), 4)):
        at = np.flatnonzero(lead)
        for k in range(size):
            inside[at + k] = False
    edge = np.diff(np.concatenate([[0], inside.view(np.int8), [0]]).astype(np.int8))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
    begins = np.concatenate([[0], np.cumsum(sizes + 1)])
    words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(buf[inside])])
    return words, np.diff(np.searchsorted(starts, begins))


class Letters:
    """Code points of words, each between two marks, and the hashes of their n-grams."""

    def __init__(self, words: pa.Array):
        text = "".join(f"\x02{w.decode('utf-8', 'replace')}\x03" for w in words.to_pylist())
        self.points = np.frombuffer(text.encode("utf-32-le"), "<u4").astype(U)
        self.word = np.cumsum(self.points == 2) - 1

    def grams(self, order: int) -> tuple[np.ndarray, np.ndarray]:
        """Word numbers and hashes of all n-grams of an order; of whole words for order 0.  Marks count
        as characters, but single marks are no n-grams."""
        if not order:
            return np.arange(self.word[-1] + 1 if len(self.word) else 0), self._whole()
        n = len(self.points) - order + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, U)
        h = np.full(n, order, U)
        for k in range(order):
            h = (h + self.points[k : k + n]) * U(0xD6E8FEB86659FD93)
            h ^= h >> U(29)
        at = np.flatnonzero((self.word[:n] == self.word[order - 1 :]) & ((order > 1) | (self.points[:n] > 3)))
        return self.word[at], mix(h[at])

    def _whole(self) -> np.ndarray:
        first = np.flatnonzero(self.points == 2)
        if not len(first):
            return np.zeros(0, U)
        place = np.arange(len(self.points)) - first[self.word]
        return mix(np.add.reduceat(mix(self.points + (place.astype(U) << U(32))), first) + U(0x9E3779B97F4A7C15))


@dataclass
class Model:
    """languages, sorted; usual: the one with most learned documents, and its share; for each order the
    sorted hashes, the stretch of each in (language, gain), and what a language gives to those it lacks."""

    languages: list[str]
    usual: int
    share: float
    orders: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]


def word_counts(texts: DataFrame) -> DataFrame:
    """word, lang, n over all rows of texts (lang, text)."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part_texts, part in chunks(batches, 1, PIECE):
            words, sizes = word_array(part_texts)
            if not len(words):
                continue
            coded, langs = words.dictionary_encode(), part.column(0).dictionary_encode()
            own = np.repeat(langs.indices.to_numpy().astype(np.int64), sizes)
            pair, n = np.unique(coded.indices.to_numpy() * len(langs.dictionary) + own, return_counts=True)
            word, lang = (pa.array(x) for x in np.divmod(pair, len(langs.dictionary)))
            yield pa.RecordBatch.from_arrays([coded.dictionary.take(word).cast(pa.binary()), langs.dictionary.take(lang), pa.array(n)], ["word", "lang", "n"])

    return texts.mapInArrow(count, "word binary, lang string, n long").groupBy("word", "lang").agg(F.sum("n").alias("n"))


def entry_counts(words: DataFrame) -> DataFrame:
    """order, hash, lang, n: the words themselves and their n-grams, each word as often as it was counted."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            letters, times = Letters(b.column(0)), b.column(2).to_numpy()
            langs = b.column(1).dictionary_encode()
            lang = langs.indices.to_numpy().astype(np.int64)
            for order in ORDERS:
                word, h = letters.grams(order)
                keys, at = np.unique(h, return_inverse=True)
                pair, of = np.unique(at * len(langs.dictionary) + lang[word], return_inverse=True)
                n = np.bincount(of, times[word], len(pair)).astype(np.int64)
                key, own = np.divmod(pair, max(1, len(langs.dictionary)))
                if len(pair):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(pair), order, np.int32)), pa.array(keys[key].view(np.int64)), langs.dictionary.take(pa.array(own)), pa.array(n)], ["order", "hash", "lang", "n"])

    return words.mapInArrow(count, "order int, hash long, lang string, n long").groupBy("order", "hash", "lang").agg(F.sum("n").alias("n"))


def learn(texts: DataFrame, share: float = SHARE) -> Model:
    """The model of texts (lang, text).  Every row is counted; what reaches the driver are the entries from
    the share on, 1 / share of an order at most."""
    texts = texts.where("lang is not null and text is not null")
    docs = dict(texts.groupBy("lang").count().collect())
    languages = sorted(docs)
    counts = stage(entry_counts(word_counts(texts)), "language-entries")
    sums = {(o, lang): n for o, lang, n in counts.groupBy("order", "lang").agg(F.sum("n")).collect()}
    totals = texts.sparkSession.createDataFrame([(o, lang, n) for (o, lang), n in sums.items()], "order int, lang string, total long")
    kept = counts.join(F.broadcast(totals), ["order", "lang"]).where(F.col("n") >= F.col("total") * (share * max(1, len(languages))))
    rows = kept.select("order", "hash", "lang", "n").toArrow()
    number = {x: i for i, x in enumerate(languages)}
    lang = rows["lang"].combine_chunks().dictionary_encode()
    lang = np.array([number[x] for x in lang.dictionary.to_pylist()], np.int64)[lang.indices.to_numpy()] if rows.num_rows else np.zeros(0, np.int64)
    order, hashes, n = (rows[c].to_numpy() for c in ("order", "hash", "n"))
    made = {}
    for o in ORDERS:
        all_of = np.array([max(1, sums.get((o, x), 0)) for x in languages], float)
        missing = np.rint(STEP * np.log(np.maximum(0.5 / all_of, share * len(languages) / 2))).astype(np.int64)
        own = np.flatnonzero(order == o)
        h = hashes[own].view(U)
        own = own[np.lexsort((lang[own], h))]
        h, who = hashes[own].view(U), lang[own]
        keys, first = np.unique(h, return_index=True)
        gain = np.rint(STEP * np.log(n[own] / all_of[who])).astype(np.int64) - missing[who] if len(own) else np.zeros(0, np.int64)
        made[o] = (keys, np.append(first, len(h)), who, gain, missing)
    usual = max(range(len(languages)), key=lambda i: docs[languages[i]], default=0)
    return Model(languages, usual, docs[languages[usual]] / sum(docs.values()) if docs else 0.0, made)


def _expand(first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For stretches of so many rows: the stretch of each row, and its place."""
    of = np.repeat(np.arange(len(first)), size)
    return of, np.arange(len(of)) - np.repeat(np.cumsum(size) - size, size) + first[of]


def word_scores(model: Model, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Integer log frequencies of distinct words (words x languages), and which words count at all.

    A word that any language has seen is scored by the word frequencies.  Of other words the longest
    n-grams that any language has seen decide, by the mean over those of that length that were seen;
    words without seen characters don't count."""
    many, some = len(words), len(model.languages)
    out, counts = np.zeros((many, some), np.int64), np.zeros(many, bool)
    letters = Letters(words)
    for order in ORDERS:
        keys, bounds, who, gain, missing = model.orders[order]
        word, h = letters.grams(order)
        if not len(keys) or not len(h):
            continue
        at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
        seen = (keys[at] == h) & ~counts[word]
        word, at = word[seen], at[seen]
        times = np.bincount(word, minlength=many)
        of, row = _expand(bounds[at], bounds[at + 1] - bounds[at])
        sums = np.bincount(word[of] * some + who[row], gain[row], many * some).astype(np.int64).reshape(many, some)
        own = times > 0
        out[own] = sums[own] // times[own, None] + missing
        counts |= own
    return out, counts


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, lang_pred and score (0 to 1, the posterior of equal priors) of every row.

    Null texts and texts without a letter are `und` with score 0, and so is everything where nothing was
    learned.  Texts of which no character was ever learned get the language of most learned documents, with
    its share as score.  Ties go to the first language in order of code points.  Whole texts count."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def judge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        some = len(model.languages)
        for texts, part in chunks(batches, 1, PIECE):
            letter = part.column(2).to_numpy(zero_copy_only=False).astype(bool)
            words, sizes = word_array(texts)
            best, score = np.full(len(texts), model.usual), np.full(len(texts), model.share)
            if some and len(words):
                coded = words.dictionary_encode()
                own, counts = word_scores(model, coded.dictionary)
                code = coded.indices.to_numpy()
                first = np.concatenate([[0], np.cumsum(sizes)])
                total = np.stack([per_doc(own[code, k], first) for k in range(some)], 1)
                known = per_doc(counts[code], first) > 0
                top = total.argmax(1)
                odds = np.exp((total - total[np.arange(len(top)), top, None]) / STEP)
                best, score = np.where(known, top, best), np.where(known, 1 / odds.sum(1), score)
            letter &= some > 0
            names = [model.languages[i] if ok else "und" for i, ok in zip(best, letter, strict=True)]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(names, pa.string()), pa.array(np.where(letter, np.round(score, 9), 0.0))], ["id", "lang_pred", "score"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), has_letter(F.col(text_col)).alias("letter"))
    return rows.mapInArrow(judge, f"id {id_type}, lang_pred string, score double").withColumnRenamed("id", id_col)


def language_id(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", share: float = SHARE) -> DataFrame:
    """Learns from all rows with a language that are not held out, by text and language only, and
    identifies every row: id, held_out, lang_pred, score.  Repeated rows are learned and judged each;
    other columns are ignored."""
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    model = learn(rows.where(~held_out(F.col("_id"))).select("lang", "text"), share)
    judged = identify(rows, model, "_id")
    return judged.select(F.col("_id").alias(id_col), held_out(F.col("_id")).alias("held_out"), "lang_pred", "score")
