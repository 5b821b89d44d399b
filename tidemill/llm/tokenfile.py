"""Token ids in seekable zstandard files.

A shard is a row of independent zstandard frames of little-endian 32-bit ids, each with its own
content checksum, then a skippable frame with the document index, then the seek table of the public
"zstd seekable format" (skippable frame: sizes and XXH64 checksum of each frame, count, magic number).
A reader fetches the tail, then decompresses only the frames that hold the documents asked for.
"""

from __future__ import annotations

import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import shared_dir, stage

SKIP_INDEX, SKIP_TABLE, SEEKABLE = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
#: A frame is closed at the first document end after so many ids.
FRAME_IDS = 1 << 16
#: Bytes of pieces and ids that a worker remembers, with ENTRY for each piece's objects; then it starts
#: afresh.  Pieces of more than KEPT characters are never remembered.
CACHE, ENTRY, KEPT = 160 << 20, 190, 64

#: Where the byte-level pattern surely breaks: Latin letters before ASCII, ASCII marks but the apostrophe
#: before a letter, digit or space, any run up to white space, and white space as the pattern takes it.
_LATIN = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
_LETTERS = re.compile(rf" ?[{_LATIN}]+")
_PLAIN = re.compile(r" ?[A-Za-z]+")
_PIECE = re.compile(rf" ?[{_LATIN}]++(?=[\x00-\x7f]|\Z)| ?[!-&(-/:-@\[-`{{-~]++(?=[A-Za-z0-9\s]|\Z)| ?[^\s]+|\s+(?!\S)|\s+", re.A)
#: White space beyond ASCII.
_SPACES = re.compile("[" + "".join(map(chr, (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000))) + "]")


def open_path(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(uri)


class PieceEncoder(dict):
    """Ids of whole texts by the tokenizers library; a dict of pieces that encodes those it lacks.

    The byte-level pattern always breaks a text at the ends of the pieces that _PIECE finds; between them
    the library sees the same characters either way.  Texts with white space
    beyond ASCII or with marks of special tokens go to the library whole.
    """

    def __init__(self, file: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(file)
        self.merge = self.tokenizer.model.tokenize
        self.size = 0
        parts = json.loads(self.tokenizer.to_str())
        split = parts["pre_tokenizer"] or {}
        if parts["normalizer"] or split.get("type") != "ByteLevel" or split.get("add_prefix_space") or not split.get("use_regex"):
            raise ValueError("only byte-level tokenizers without a normaliser or prefix space")
        self.ids = [struct.pack("<I", i) for i in range(self.tokenizer.get_vocab_size())]
        spare = (c for c in range(256, 512))
        self.marks = {b: b if 33 <= b < 127 or 161 <= b < 173 or 174 <= b else next(spare) for b in range(256)}
        self.space = chr(self.marks[32])

    def _library(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def __missing__(self, piece: str) -> bytes:
        """Runs of letters go straight to the library's merges, in its byte alphabet; others go through
        all its steps."""
        if _PLAIN.fullmatch(piece):
            own = self.space + piece[1:] if piece[0] == " " else piece
        elif _LETTERS.fullmatch(piece):
            own = piece.encode().decode("latin-1").translate(self.marks)
        else:
            own = None
        ids = self.ids
        out = self._library(piece) if own is None else b"".join([ids[t.id] for t in self.merge(own)])
        if len(piece) <= KEPT:
            self.size += len(piece) + len(out) + ENTRY
            self[piece] = out
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian 32-bit integers."""
        out = []
        for x in texts:
            if "<|" in x or not x.isascii() and _SPACES.search(x):
                out.append(self._library(x))
                continue
            out.append(b"".join(map(self.__getitem__, _PIECE.findall(x))))
            if self.size > CACHE:
                self.clear()
                self.size = 0
        return out


_encoders: dict[str, PieceEncoder] = {}


def encoder(file: str) -> PieceEncoder:
    if file not in _encoders:
        _encoders[file] = PieceEncoder(file)
    return _encoders[file]


def write_shard(out, docs: Iterable[tuple[int | None, bytes]], frame_ids: int = FRAME_IDS) -> tuple[int, int]:
    """Writes (doc_id, ids) in the order given to a binary stream; returns documents and ids written."""
    press = zstandard.ZstdCompressor(level=1, write_checksum=True)
    table, held, size, total = [], [], 0, 0
    index: list[tuple[int, int, int, int]] = []  # id, null, ids, frame

    def close() -> None:
        nonlocal held, size
        if index and (held or not table):
            raw = b"".join(held)
            frame = press.compress(raw)
            out.write(frame)
            table.append((len(frame), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))
            held, size = [], 0

    for doc_id, ids in docs:
        index.append((doc_id or 0, doc_id is None, len(ids) // 4, len(table)))
        held.append(ids)
        size += len(ids) // 4
        total += len(ids) // 4
        if size >= frame_ids:
            close()
    close()
    packed = press.compress(np.array(index, "<i8").reshape(len(index), 4).tobytes())
    out.write(struct.pack("<II", SKIP_INDEX, len(packed)) + packed)
    table.append((len(packed) + 8, 0, xxhash.xxh64_intdigest(b"") & 0xFFFFFFFF))
    body = b"".join(struct.pack("<III", *x) for x in table) + struct.pack("<IBI", len(table), 0x80, SEEKABLE)
    out.write(struct.pack("<II", SKIP_TABLE, len(body)) + body)
    return len(index), total


class Shard:
    """Random access to one shard."""

    def __init__(self, source):
        self.file, size = source, source.size()
        n, kind, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != SEEKABLE or not kind & 0x80:
            raise ValueError("no seek table")
        entries = np.frombuffer(self._at(size - 9 - 12 * n, 12 * n), "<u4").reshape(n, 3).astype(np.int64)
        self.sizes, self.checks = entries[:, 1], entries[:, 2]
        self.starts = np.concatenate([[0], np.cumsum(entries[:, 0])])
        packed = self._at(self.starts[n - 1] + 8, entries[n - 1, 0] - 8)
        self.index = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), "<i8").reshape(-1, 4)

    def _at(self, start: int, size: int) -> bytes:
        self.file.seek(int(start))
        return self.file.read(int(size))

    def frame(self, k: int) -> bytes:
        raw = zstandard.ZstdDecompressor().decompress(self._at(self.starts[k], self.starts[k + 1] - self.starts[k])) if self.sizes[k] else b""
        if len(raw) != self.sizes[k] or xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != self.checks[k]:
            raise ValueError(f"frame {k} is damaged")
        return raw

    def documents(self, wanted: set[int | None] | None = None) -> Iterator[tuple[int | None, int, bytes]]:
        """(doc_id, ids before it in the shard, ids) of all or the wanted documents."""
        before = np.concatenate([[0], np.cumsum(self.index[:, 2])])
        first = np.searchsorted(self.index[:, 3], np.arange(len(self.sizes)))
        held, raw = -1, b""
        for i, (doc_id, null, n, k) in enumerate(self.index.tolist()):
            key = None if null else doc_id
            if wanted is None or key in wanted:
                if k != held:
                    held, raw = k, self.frame(k)
                at = 4 * int(before[i] - before[first[k]])
                yield key, int(before[i]), raw[at : at + 4 * n]


def write_tokens(docs: DataFrame, folder: str, tokenizer_file: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encodes docs in ascending id order and writes one shard a partition into folder, a URI that all
    executors reach.  Returns the manifest: place, path, docs, ids, start (ids in shards before).

    Only files in the manifest count: a task that is run again writes a file of its own.  Null ids come
    last, repeated ids in the order of their texts' hashes; null text is empty: the end id alone.
    An empty table writes no shard.
    """
    at = [F.asc_nulls_last("id"), F.asc("h")]
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.withColumn("h", F.xxhash64("text")).repartitionByRange(*at).sortWithinPartitions(*at).select("id", "text")
    end = struct.pack("<I", end_id)

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = encoder(tokenizer_file)
        batches = (b for b in batches if b.num_rows)
        first = next(batches, None)
        if first is None:
            return

        def ids():
            for b in (x for y in ([first], batches) for x in y):
                for start in range(0, b.num_rows, 64):
                    part = b.slice(start, 64)
                    for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                        yield doc_id, made.encode([text])[0] + end

        place = TaskContext.get().partitionId()
        path = f"{folder}/part-{place:05d}-{uuid.uuid4().hex}.zst"
        fs, name = open_path(path)
        fs.create_dir(name.rpartition("/")[0], recursive=True)
        with fs.open_output_stream(name, compression=None) as out:
            n, total = write_shard(out, ids())
        yield pa.RecordBatch.from_pydict({"place": [place], "path": [path], "docs": [n], "ids": [total]})

    shards = stage(rows.mapInArrow(write, "place long, path string, docs long, ids long"), "shards")
    starts, before = [], 0
    for place, n in sorted((r["place"], r["ids"]) for r in shards.select("place", "ids").collect()):  # one row a shard
        starts.append((place, before))
        before += n
    return shards.join(F.broadcast(docs.sparkSession.createDataFrame(starts, "place long, start long")), "place")


def read_tokens(manifest: DataFrame) -> DataFrame:
    """One row per document in the files of a manifest: doc_id, start (ids of all documents before),
    n_tokens and ids_crc32, one file a task."""

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, start in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                fs, name = open_path(path)
                with fs.open_input_file(name) as file:
                    rows = [(d, start + at, len(ids) // 4, zlib.crc32(ids)) for d, at, ids in Shard(file).documents()]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], ["doc_id", "start", "n_tokens", "ids_crc32"])

    n = max(1, manifest.count())
    return manifest.select("path", "start").repartition(n, "path").mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def tokens_folder(spark) -> str:
    return f"{shared_dir(spark)}/tokens-{uuid.uuid4().hex}"
