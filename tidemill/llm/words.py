"""Words of many texts at once, as numpy arrays: places, hashes, windows."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_powers = {"up": np.ones(1, U), "down": np.ones(1, U)}
#: Texts are worked on together until they hold so many bytes; a longer text is worked on alone, whole.
CHUNK = 1 << 20


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the hash base and of its inverse, modulo 2^64."""
    if len(_powers["up"]) < n:
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            steps = np.full(max(n, CHUNK + 1), base, U)
            steps[0] = 1
            _powers[name] = np.cumprod(steps, dtype=U)
    return _powers["up"][:n], _powers["down"][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def lower_bytes(buf: np.ndarray) -> np.ndarray:
    """A-Z in lower case, other bytes as they are."""
    return buf + ((buf >= 65) & (buf <= 90)).astype(np.uint8) * np.uint8(32)


class Words:
    """The words [^\\x20\\x09-\\x0D]+ of texts given as UTF-8.

    first[k]:first[k + 1] are the words of text k; starts and ends are places in buf; hash is a 64-bit
    hash of each word's bytes; doc is each word's text."""

    def __init__(self, texts: list[bytes], lower: bool = False):
        buf = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
        self.buf = buf = lower_bytes(buf) if lower else buf
        self.begins = np.concatenate([[0], np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)])
        self.space = (buf == 32) | ((buf >= 9) & (buf <= 13))
        edge = np.diff(np.concatenate([[1], self.space.view(np.int8), [1]]).astype(np.int8))
        self.starts, self.ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        up, down = powers(len(buf) + 1)
        run = np.zeros(len(buf) + 1, U)
        np.cumsum(buf.astype(U) * up[:-1], out=run[1:])
        self.hash = mix((run[self.ends] - run[self.starts]) * down[self.starts] + (self.ends - self.starts).astype(U))
        self.first = np.searchsorted(self.starts, self.begins)
        self.doc = np.repeat(np.arange(len(texts)), np.diff(self.first))

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Places (of first words) and hashes of all windows of so many words inside one text."""
        n = len(self.hash) - size + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, U)
        h = np.zeros(n, U)
        for k in range(size):
            h = (h + self.hash[k : k + n]) * U(0xD6E8FEB86659FD93)
        at = np.flatnonzero(self.doc[:n] == self.doc[size - 1 :])
        return at, mix(h[at])


def per_doc(mask: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of mask between neighbouring bounds."""
    run = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
    return run[bounds[1:]] - run[bounds[:-1]]


def chunks(batches: Iterable[pa.RecordBatch], text: int, most: int = CHUNK) -> Iterator[tuple[list[bytes], pa.RecordBatch]]:
    """Texts (column number text, null as empty, as bytes) with their rows, in pieces of about `most`
    bytes; only the texts of one piece are Python objects at a time."""
    for b in batches:
        column = b.column(text).cast(pa.large_binary())
        sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes + 1)
        start = 0
        while start < b.num_rows:
            before = int(ends[start - 1]) if start else 0
            end = max(start + 1, int(np.searchsorted(ends, before + most, "right")))
            yield [x or b"" for x in column.slice(start, end - start).to_pylist()], b.slice(start, end - start)
            start = end
