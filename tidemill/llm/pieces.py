"""SentencePiece encoding and decoding in batches of numpy arrays.

Distinct words of equal length advance together.  Hashes of all their substrings probe the sorted keys
of the pieces, which gives a table of piece numbers by place and length.  Unigram models then take the
Viterbi path: vectorised maxima with backpointers.  A model of merges has no score that adds up along a
path, so for it the same table drives its merges instead: in each round every word joins its best
neighbouring pair.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, LongType, StructField, StructType

from .words import U, chunks, mix, powers

SPACE = "▁"
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
#: Bytes of words and ids that a worker remembers, with ENTRY for each word's objects; beyond it only
#: the words of the texts at hand stay.  Words of more than KEPT characters are never remembered.
CACHE, ENTRY, KEPT = 96 << 20, 200, 64
#: Texts are encoded together until they hold so many bytes; a longer text is encoded alone, whole.
CHUNK = 4 << 20
#: Longer words of a model of merges are merged with a heap, one at a time.
LONG = 48


def _fields(raw: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and values of a protocol buffer message."""

    def number(i: int) -> tuple[int, int]:
        out = shift = 0
        while True:
            b = raw[i]
            i += 1
            out |= (b & 127) << shift
            shift += 7
            if b < 128:
                return out, i

    i = 0
    while i < len(raw):
        key, i = number(i)
        if key & 7 == 0:
            value, i = number(i)
        else:
            n, i = (8, i) if key & 7 == 1 else (4, i) if key & 7 == 5 else number(i)
            value, i = raw[i : i + n], i + n
        yield key >> 3, value


class Model:
    """A SentencePiece model: pieces, scores, and how text is prepared."""

    def __init__(self, raw: bytes):
        pieces: list[tuple[str, float, int]] = []
        self.kind, self.prefix, self.squeeze, byte_fallback, rules = UNIGRAM, True, True, False, b""
        for n, value in _fields(raw):
            if n == 1:
                own = dict(_fields(value))
                pieces.append((own[1].decode(), float(np.frombuffer(own.get(2, bytes(4)), "<f4")[0]), own.get(3, NORMAL)))
            elif n == 2:
                own = dict(_fields(value))
                self.kind, byte_fallback = own.get(3, UNIGRAM), bool(own.get(35, 0))
            elif n == 3:
                own = dict(_fields(value))
                self.prefix, self.squeeze, rules = bool(own.get(3, 1)), bool(own.get(4, 1)), own.get(2, b"")
        if rules or self.squeeze or any(t == USER for _, _, t in pieces) or self.kind not in (UNIGRAM, BPE):
            raise ValueError("only models with identity normalisation, kept white space and no user-defined pieces")
        self.pieces = [p for p, _, _ in pieces]
        self.types = np.array([t for _, _, t in pieces])
        self.scores = np.array([s for _, s, _ in pieces])
        self.unknown = int(np.flatnonzero(self.types == UNKNOWN)[0])
        self.bytes = np.array([int(np.flatnonzero([p == f"<0x{b:02X}>" for p in self.pieces])[0]) for b in range(256)]) if byte_fallback else None
        usable = np.flatnonzero(self.types == NORMAL)
        self.ids = {self.pieces[i]: int(i) for i in usable}
        self.longest = max(len(self.pieces[i]) for i in usable)
        flat = "".join(self.pieces[i] for i in usable)
        sizes = np.array([len(self.pieces[i]) for i in usable])
        starts = np.cumsum(sizes) - sizes
        run = self._running(np.frombuffer(flat.encode("utf-32-le"), "<u4")[None, :])
        keys = self._keys(run[0], starts, sizes)
        order = np.argsort(keys)
        self.keys, self.key_ids = keys[order], usable[order]
        self.likely = np.zeros(1 << 20, bool)
        self.likely[self.keys >> U(44)] = True
        if any(SPACE in p.lstrip(SPACE) for p in self.ids):
            raise ValueError("a piece goes on after a space")
        known = set(flat)
        cut = "".join(c for c in "\n\t\r" if c not in known)
        self.split = re.compile(f"{SPACE}*[^{SPACE}{cut}]+|{SPACE}+" + (f"|[{cut}]" if cut else ""))
        self.lowest = float(self.scores[usable].min())
        self.texts = [bytes([int(p[1:-1], 16)]) if t == BYTE else b"" if t == CONTROL else b" \xe2\x81\x87 " if t == UNKNOWN else p.replace(SPACE, " ").encode() for p, t in zip(self.pieces, self.types.tolist(), strict=True)]

    @staticmethod
    def _running(chars: np.ndarray) -> np.ndarray:
        up, _ = powers(chars.shape[1] + 1)
        out = np.zeros((chars.shape[0], chars.shape[1] + 1), U)
        np.cumsum((chars.astype(U) + U(1)) * up[: chars.shape[1]], axis=1, out=out[:, 1:])
        return out

    @staticmethod
    def _keys(run: np.ndarray, starts: np.ndarray, sizes) -> np.ndarray:
        _, down = powers(int(starts.max(initial=0)) + 1 + int(np.max(sizes)))
        return mix((run[..., starts + sizes] - run[..., starts]) * down[starts] + np.asarray(sizes).astype(U))

    def table(self, chars: np.ndarray) -> np.ndarray:
        """Piece numbers [word, place, length - 1] of all substrings, -1 where there is none."""
        m, n = chars.shape
        run, k = self._running(chars), min(n, self.longest)
        out = np.full((m, n, k), -1, np.int32)
        for size in range(1, k + 1):
            keys = self._keys(run, np.arange(n - size + 1), np.full(n - size + 1, size))
            word, place = np.nonzero(self.likely[keys >> U(44)])  # most others are no piece
            keys = keys[word, place]
            at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            out[word, place, size - 1] = np.where(self.keys[at] == keys, self.key_ids[at], -1)
        return out

    def viterbi(self, chars: np.ndarray) -> list[list[tuple[int, int, int]]]:
        """For each word the best path as (piece or -1, start, end)."""
        table, (m, n) = self.table(chars), chars.shape
        best, back = np.full((m, n + 1), -np.inf), np.zeros((m, n + 1), np.int64)
        best[:, 0] = 0
        for end in range(1, n + 1):
            starts = np.arange(max(0, end - table.shape[2]), end)
            ids = table[:, starts, end - starts - 1]
            score = np.where(ids >= 0, self.scores[ids], -np.inf)
            score[:, -1] = np.where(ids[:, -1] >= 0, score[:, -1], self.lowest - 10)
            score = score + best[:, starts]
            pick = score.argmax(1)
            best[:, end], back[:, end] = score[np.arange(m), pick], starts[pick]
        out = []
        for w in range(m):
            end, path = n, []
            while end:
                start = int(back[w, end])
                path.append((int(table[w, start, end - start - 1]), start, end))
                end = start
            out.append(path[::-1])
        return out

    def merges(self, chars: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Words whose merges are done, by number of symbols left: (words, pieces or -1, bounds), where
        symbol i of a word is bounds[i]:bounds[i + 1]."""
        table, (m, n) = self.table(chars), chars.shape
        k, left, bounds = table.shape[2], np.arange(m), np.tile(np.arange(n + 1), (m, 1))
        while len(left):
            if bounds.shape[1] > 2:
                size = bounds[:, 2:] - bounds[:, :-2]
                ids = np.where(size <= k, table[left[:, None], bounds[:, :-2], np.minimum(size, k) - 1], -1)
                score = np.where(ids >= 0, self.scores[ids], -np.inf)
                pick = score.argmax(1)
                more = score[np.arange(len(left)), pick] > -np.inf
            else:
                pick, more = np.zeros(len(left), np.int64), np.zeros(len(left), bool)
            if not more.all():
                own, rows = bounds[~more], left[~more]
                yield rows, table[rows[:, None], own[:, :-1], np.minimum(np.diff(own), k) - 1], own
            left, bounds, pick = left[more], bounds[more], pick[more]
            keep = np.ones(bounds.shape, bool)
            keep[np.arange(len(left)), pick + 1] = False
            bounds = bounds[keep].reshape(len(left), -1) if len(left) else bounds

    def merge_long(self, word: str) -> list[tuple[int, int, int]]:
        """The same for one long word, with a heap of pairs."""
        n = len(word)
        nxt, prev, size = list(range(1, n + 1)), list(range(-1, n - 1)), [1] * n
        heap: list[tuple[float, int, int, int]] = []

        def offer(a: int) -> None:
            b = nxt[a]
            if a >= 0 and b < n and size[a] + size[b] <= self.longest:
                i = self.ids.get(word[a : b + size[b]])
                if i is not None:
                    heapq.heappush(heap, (-self.scores[i], a, size[a], size[b]))

        for a in range(n - 1):
            offer(a)
        while heap:
            _, a, x, y = heapq.heappop(heap)
            b = a + x
            if size[a] != x or b >= n or size[b] != y or nxt[a] != b:
                continue
            size[a], size[b], nxt[a] = x + y, 0, nxt[b]
            if nxt[b] < n:
                prev[nxt[b]] = a
            if prev[a] >= 0:
                offer(prev[a])
            offer(a)
        out, a = [], 0
        while a < n:
            out.append((self.ids.get(word[a : a + size[a]], -1), a, a + size[a]))
            a = nxt[a]
        return out

    def _numbers(self, word: str, path: list[tuple[int, int, int]]) -> bytes:
        ids: list[int] = []
        for i, a, b in path:
            if i >= 0:
                ids.append(i)
            elif self.bytes is not None:
                ids += self.bytes[list(word[a:b].encode())].tolist()
            elif not ids or ids[-1] != self.unknown:
                ids.append(self.unknown)
        return np.array(ids, "<i4").tobytes()

    def encode_words(self, words: Iterable[str]) -> dict[str, bytes]:
        """Ids of distinct words as little-endian 32-bit integers."""
        by_size: dict[int, list[str]] = {}
        out: dict[str, bytes] = {}
        for w in words:
            if self.kind == BPE and len(w) > LONG:
                out[w] = self._numbers(w, self.merge_long(w))
            else:
                by_size.setdefault(len(w), []).append(w)
        for n, group in by_size.items():
            step = max(1, (1 << 16) // n)
            for start in range(0, len(group), step):
                part = group[start : start + step]
                chars = np.frombuffer("".join(part).encode("utf-32-le"), "<u4").reshape(len(part), n)
                if self.kind == UNIGRAM:
                    out.update((w, self._numbers(w, p)) for w, p in zip(part, self.viterbi(chars), strict=True))
                    continue
                for rows, ids, bounds in self.merges(chars):
                    raw, width, whole = ids.astype("<i4").tobytes(), 4 * ids.shape[1], (ids >= 0).all(1)
                    for i, (row, good) in enumerate(zip(rows.tolist(), whole.tolist(), strict=True)):
                        w = part[row]
                        out[w] = raw[i * width : i * width + width] if good else self._numbers(w, list(zip(ids[i].tolist(), bounds[i, :-1].tolist(), bounds[i, 1:].tolist(), strict=True)))
        return out

    def words(self, text: str) -> list[str]:
        """The text as prepared and cut where no piece goes across."""
        if not text:
            return []
        return self.split.findall((SPACE if self.prefix else "") + text.replace(" ", SPACE))

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids; bytes that are no UTF-8 become U+FFFD."""
        out = b"".join(map(self.texts.__getitem__, ids.tolist())).decode("utf-8", "replace")
        return out[1:] if self.prefix and out.startswith(" ") else out


class Encoder:
    """Whole texts to ids; each distinct word is encoded once while it is remembered."""

    def __init__(self, file: str):
        self.model = Model(Path(file).read_bytes())
        self.known: dict[str, bytes] = {}
        self.size = 0
        #: Words whose ids do not decode to them.
        self.lossy: set[str] = set()

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian 32-bit integers."""
        return [ids for ids, _ in self.checked(texts)]

    def checked(self, texts: list[str]) -> list[tuple[bytes, bool]]:
        """For each text its ids and whether they decode to it: pieces end where words do, and words
        hold whole characters, so a text comes back if all its words do."""
        words = [self.model.words(x) for x in texts]
        distinct = set().union(*words)
        missing = distinct.difference(self.known)
        made = self.model.encode_words(missing)
        pieces = self.model.texts
        self.lossy.update(w for w, ids in made.items() if b"".join([pieces[i] for i in np.frombuffer(ids, "<i4").tolist()]) != w.replace(SPACE, " ").encode())
        self.known |= made
        self.size += sum(len(w) + len(ids) + ENTRY for w, ids in made.items())
        lossy = self.lossy
        out = [(b"".join(map(self.known.__getitem__, own)), SPACE not in x and (not lossy or lossy.isdisjoint(own))) for x, own in zip(texts, words, strict=True)]
        if self.size > CACHE:
            self.known = {w: self.known[w] for w in distinct}
            self.size = sum(len(w) + len(ids) + ENTRY for w, ids in self.known.items())
            if self.size > CACHE // 2:
                self.known, self.size = {}, 0
        else:
            for w in [w for w in made if len(w) > KEPT]:
                self.size -= len(w) + len(self.known.pop(w)) + ENTRY
        self.lossy.intersection_update(self.known)
        return out


_encoders: dict[str, Encoder] = {}


def encoder(file: str) -> Encoder:
    if file not in _encoders:
        _encoders[file] = Encoder(file)
    return _encoders[file]


def _lists(parts: Iterable[bytes]) -> pa.ListArray:
    ends = np.cumsum([0, *(len(x) // 4 for x in parts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(parts), "<i4")))


def encode(docs: DataFrame, file: str, text_col: str = "text") -> DataFrame:
    """All rows of docs, the text replaced by ids (array<int>), n_tokens, and round_trip: whether the ids
    decode to the text.  (A text that holds U+2581 itself decodes with spaces in its place.)

    Null text is empty text, which has no ids; columns of docs named like the added ones are replaced;
    other columns stay as they are; repeated rows are encoded alike.  file is a path on every executor.
    """
    added = [StructField("ids", ArrayType(IntegerType(), False)), StructField("n_tokens", LongType()), StructField("round_trip", BooleanType())]
    names = [c for c in docs.columns if c not in {f.name for f in added}]
    rows = docs.select(*names)
    at, rest = names.index(text_col), [i for i, c in enumerate(names) if c != text_col]
    out_names = [*(names[i] for i in rest), *(f.name for f in added)]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = encoder(file)
        for texts, b in chunks(batches, at, CHUNK):
            parts, same = zip(*made.checked([x.decode() for x in texts]), strict=True)
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in rest), _lists(parts), pa.array([len(p) // 4 for p in parts], pa.int64()), pa.array(same)], out_names)

    return rows.mapInArrow(run, StructType([*(rows.schema.fields[i] for i in rest), *added]))


def decode(tokens: DataFrame, file: str, ids_col: str = "ids", text_col: str = "text") -> DataFrame:
    """All rows of tokens with the text of their ids; null ids give null.  Numbers that the model lacks
    are an error."""
    from pyspark.sql.types import StringType

    names = [c for c in tokens.columns if c != text_col]
    rows = tokens.select(*names)
    at = names.index(ids_col)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = encoder(file).model
        for b in batches:
            texts = [None if x is None else model.decode(np.array(x, np.int64)) for x in b.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string())], [*names, text_col])

    return rows.mapInArrow(run, StructType([*rows.schema.fields, StructField(text_col, StringType())]))
