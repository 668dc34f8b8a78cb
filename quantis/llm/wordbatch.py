"""Vectorised words of Arrow text columns.

A *word* is a maximal run of characters other than space and the control
characters 0x09-0x0D.  All of these separators are single bytes in UTF-8 and
never occur inside a longer sequence, so words are found on the raw UTF-8
buffer of an Arrow column: no Python string is made.  Long columns are cut
into slices of whole documents (about ``SLICE_BYTES`` each), which bounds the
memory of the integer arrays built over the bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
U64 = np.uint64

# Odd multipliers of the hashes.
PLACE = 0x9E3779B97F4A7C15
SIZE = 0xD1342543DE82EF95
LEFT = 0x9FB21C651E98DF25
RIGHT = 0xC2B2AE3D27D4EB4F

IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER_AZ = np.arange(256, dtype=np.uint8)
LOWER_AZ[65:91] += 32


@dataclass
class Words:
    """Words of a run of documents: ``data`` holds the UTF-8 bytes of all
    texts, ``offsets`` the byte range of each document, ``start``/``end`` the
    byte range of each word and ``first`` the word range of each document."""

    row: int  # position of the first document in the batch
    data: np.ndarray
    offsets: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    @property
    def n_docs(self) -> int:
        return len(self.offsets) - 1

    @property
    def doc(self) -> np.ndarray:
        """Document (position in this slice) of each word."""
        return np.repeat(np.arange(self.n_docs), np.diff(self.first))


def texts(column: pa.Array | pa.ChunkedArray) -> pa.LargeStringArray:
    """The column as one array of large strings, nulls as empty texts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return pc.fill_null(column.cast(pa.large_string()), "")


def utf8(column: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and document offsets of a column without nulls."""
    _, off, data = column.buffers()
    o = np.frombuffer(off, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, dtype=np.uint8)[o[0] : o[-1]], o - o[0]


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of documents of at most ``limit`` bytes (one document at least)."""
    n, a = len(offsets) - 1, 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + limit, side="right")) - 1)
        yield a, min(b, n)
        a = b


def split_words(column: pa.Array | pa.ChunkedArray, lower: bool = False, limit: int = SLICE_BYTES) -> Iterator[Words]:
    """Words of each slice of a text column; ``lower`` maps A-Z to a-z."""
    data, off = utf8(texts(column))
    for a, b in slices(off, limit):
        d, o = data[off[a] : off[b]], off[a : b + 1] - off[a]
        if lower:
            d = LOWER_AZ[d]
        word = ~IS_SPACE[d]
        # a document's first byte begins a word, its last byte ends one
        edge = np.zeros(len(d) + 1, dtype=bool)
        edge[o] = True
        gap = np.ones(len(d) + 2, dtype=bool)
        gap[1:-1] = ~word
        start = np.flatnonzero(word & (gap[:-2] | edge[:-1]))
        end = np.flatnonzero(word & (gap[2:] | edge[1:])) + 1
        yield Words(a, d, o, start, end, np.searchsorted(start, o))


def mix(h: np.ndarray) -> np.ndarray:
    """64-bit finaliser: spreads every bit of the input over the result."""
    h = h ^ (h >> U64(33))
    h = h * U64(0xFF51AFD7ED558CCD)
    h ^= h >> U64(33)
    h = h * U64(0xC4CEB9FE1A85EC53)
    h ^= h >> U64(33)
    return h


def bytes_hash(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each span of bytes.

    A span is read in lanes of eight bytes; every lane is mixed with its place
    before the lanes are added up, so no two spans share a hash by the algebra
    of a polynomial, however regular they are."""
    if not len(start):
        return np.zeros(0, U64)
    size = end - start
    lanes = np.maximum(1, (size + 7) >> 3)
    first = np.cumsum(lanes) - lanes
    rank = np.arange(int(lanes.sum())) - np.repeat(first, lanes)
    at = np.repeat(start, lanes) + 8 * rank
    left = np.minimum(np.repeat(size, lanes) - 8 * rank, 8)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    lane = np.lib.stride_tricks.sliding_window_view(padded, 8)[at].view("<u8").ravel()
    kept = np.array([(1 << (8 * n)) - 1 for n in range(9)], U64)[left]
    mixed = mix((lane & kept) ^ (rank.astype(U64) + U64(1)) * U64(PLACE))
    return mix(np.add.reduceat(mixed, first) + size.astype(U64) * U64(SIZE))


def same_bytes(data: np.ndarray, a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Whether the spans of ``a`` (starts, ends) equal those of ``b``."""
    size = a[1] - a[0]
    equal = size == b[1] - b[0]
    some = np.flatnonzero(equal & (size > 0))
    if len(some):
        n = size[some]
        first = np.cumsum(n) - n
        step = np.arange(int(n.sum())) - np.repeat(first, n)
        differs = data[np.repeat(a[0][some], n) + step] != data[np.repeat(b[0][some], n) + step]
        equal[some] = ~np.logical_or.reduceat(differs, first)
    return equal


def word_hash(w: Words) -> np.ndarray:
    """64-bit hash of each word's bytes."""
    return bytes_hash(w.data, w.start, w.end)


def _pair_hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = a * U64(LEFT)
    x ^= x >> U64(32)
    x += b
    x *= U64(RIGHT)
    x ^= x >> U64(29)
    return x


def run_hash(h: np.ndarray, n: int, salt: int = 0) -> np.ndarray:
    """Hash of each run of ``n`` consecutive word hashes (also of runs that
    cross documents: see ``inside``), from the hashes of its two halves, which
    overlap where ``n`` is no power of two."""
    if len(h) < n:
        return np.zeros(0, dtype=U64)
    x, size = mix(h + U64(salt)), 1
    while size < n:
        step = min(size, n - size)
        x = _pair_hash(x[: len(x) - step], x[step:])
        size += step
    return mix(x + U64(n))


def sequence_hash(h: np.ndarray) -> np.ndarray:
    """Hash of one whole sequence of word hashes, of any length."""
    place = np.arange(1, len(h) + 1, dtype=U64) * U64(PLACE)
    return mix(np.array([mix(h ^ place).sum(dtype=U64)]) + U64(len(h)) * U64(SIZE))


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted distinct values, by sorting (``np.unique`` alone hashes, which
    takes several times as long on millions of numbers)."""
    s = np.sort(values)
    return s[np.concatenate([[True], s[1:] != s[:-1]])] if len(s) else s


def inside(first: np.ndarray, n: int, total: int) -> np.ndarray:
    """Which runs of ``n`` words (by their first word) lie in one document."""
    ok = np.zeros(max(total + 1, 1), dtype=np.int64)
    last = np.maximum(first[1:] - n + 1, first[:-1])
    np.add.at(ok, first[:-1], 1)
    np.add.at(ok, last, -1)
    return (np.cumsum(ok)[: max(total - n + 1, 0)]) > 0
