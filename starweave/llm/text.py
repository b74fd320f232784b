"""Words of many texts at once, as numpy arrays over their UTF-8 bytes."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that one step of a task holds as arrays; a longer text is a step alone.
BLOCK_BYTES = 1 << 20

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: a bijection that spreads every input bit."""
    x = np.asarray(x, dtype=np.uint64)
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * _M1
        x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def seeded(n: int, seed: int) -> np.ndarray:
    """``n`` fixed pseudorandom 64-bit values."""
    with np.errstate(over="ignore"):
        return mix(np.arange(1, n + 1, dtype=np.uint64) * _STEP + mix(np.uint64(seed)))


_BYTE = seeded(256, 11)
_BASE = np.uint64(seeded(1, 12)[0] | np.uint64(1))


def byte_class(pattern: Callable[[int], bool]) -> np.ndarray:
    return np.array([pattern(b) for b in range(256)], dtype=bool)


#: Bytes of words that are parted by white space: everything but 0x20 and 0x09 to 0x0D.
SPACED = byte_class(lambda b: b != 0x20 and not 0x09 <= b <= 0x0D)


@dataclass
class Words:
    """Words of a block of texts: byte ranges in ``data`` and the text each is in."""

    data: np.ndarray
    bounds: np.ndarray  # byte offsets of the texts
    start: np.ndarray
    end: np.ndarray

    @cached_property
    def doc(self) -> np.ndarray:
        return np.searchsorted(self.bounds, self.start, side="right") - 1

    @property
    def n_docs(self) -> int:
        return len(self.bounds) - 1

    @cached_property
    def first(self) -> np.ndarray:
        """Index of the first word of each text, and the number of words at the end."""
        return np.searchsorted(self.start, self.bounds)

    @cached_property
    def hash(self) -> np.ndarray:
        """64-bit hash of each word."""
        size = self.end - self.start
        if not len(size):
            return np.empty(0, np.uint64)
        total = np.concatenate(([0], np.cumsum(size)))
        inside = np.arange(total[-1]) - np.repeat(total[:-1], size)
        power = np.empty(int(size.max()), np.uint64)
        power[0] = 1
        power[1:] = _BASE
        with np.errstate(over="ignore"):
            power = np.multiply.accumulate(power)
            value = _BYTE[self.data[inside + np.repeat(self.start, size)]] * power[inside]
            return mix(np.add.reduceat(value, total[:-1]) + size.astype(np.uint64))

    def per_doc(self, of_word: np.ndarray) -> np.ndarray:
        """Sums over the words of each text."""
        total = np.concatenate(([0], np.cumsum(of_word)))
        return total[self.first[1:]] - total[self.first[:-1]]

    def per_doc_bytes(self, of_byte: np.ndarray) -> np.ndarray:
        """Sums over the bytes of each text."""
        total = np.concatenate(([0], np.cumsum(of_byte)))
        return total[self.bounds[1:]] - total[self.bounds[:-1]]

    def text(self, word: int) -> bytes:
        return self.data[self.start[word] : self.end[word]].tobytes()


def words(texts: Iterable[bytes], chars: np.ndarray = SPACED) -> Words:
    """Maximal runs of bytes in the class ``chars``, not crossing texts."""
    texts = list(texts)
    bounds = np.concatenate(([0], np.cumsum([len(t) for t in texts], dtype=np.int64)))
    bounds = bounds.astype(np.int64)
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    inside = chars[data]
    before = np.zeros(len(data), bool)
    before[1:] = inside[:-1]
    edge = bounds[:-1][bounds[:-1] < len(data)]
    before[edge] = False
    after = np.zeros(len(data), bool)
    after[:-1] = inside[1:]
    edge = bounds[1:][bounds[1:] > 0] - 1
    after[edge] = False
    return Words(data, bounds, np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1)


def shingles(w: Words, k: int = 5) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, text and first word of each run of ``k`` words in a text.

    A text of 1 to ``k - 1`` words has one shingle: all of them. Without words it
    has none.
    """
    h, n = w.hash, len(w.start)
    counts = np.diff(w.first)
    full = np.maximum(counts - k + 1, (counts > 0).astype(np.int64))
    total = np.concatenate(([0], np.cumsum(full)))
    doc = np.repeat(np.arange(w.n_docs), full)
    at = np.arange(total[-1]) - np.repeat(total[:-1], full) + np.repeat(w.first[:-1], full)
    out = np.zeros(total[-1], np.uint64)
    last = w.first[1:][doc]
    salt = seeded(k, 13) | np.uint64(1)
    with np.errstate(over="ignore"):
        for j in range(k):
            there = at + j < last
            out += np.where(there, h[np.minimum(at + j, max(n - 1, 0))] * salt[j], _STEP * salt[j])
    return mix(out), doc, at


def occurrence(key: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """How many equal keys come before each one in its text (keys in text order)."""
    if not len(key):
        return np.empty(0, np.int64)
    order = np.lexsort((key, doc))
    k, d = key[order], doc[order]
    new = np.concatenate(([True], (k[1:] != k[:-1]) | (d[1:] != d[:-1])))
    begins = np.flatnonzero(new)
    rank = np.arange(len(k)) - np.repeat(begins, np.diff(np.append(begins, len(k))))
    out = np.empty(len(k), np.int64)
    out[order] = rank
    return out


def encoded(column: pa.Array) -> list[bytes]:
    """Texts as UTF-8, null as empty."""
    return [t or b"" for t in column.cast(pa.large_binary()).to_pylist()]


def blocks(batches: Iterable[pa.RecordBatch], *columns: str, limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the named text columns of a piece hold about ``limit`` bytes."""
    for batch in batches:
        size = np.full(batch.num_rows, 64, np.int64)
        for name in columns:
            length = pc.fill_null(pc.binary_length(batch.column(name)), 0)
            size += np.asarray(length.cast(pa.int64()))
        place = (np.cumsum(size) - size) // limit
        cuts = [0, *(np.flatnonzero(np.diff(place)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            if b > a:
                yield batch.slice(a, b - a)
