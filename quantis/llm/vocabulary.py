"""Distinct words with counts, gathered in tasks and summed by buckets.

A task keeps each distinct word of its texts once.  Words travel as one
space-joined text for each bucket of word hashes, with a count for each word,
so that a word of a third of all tokens costs one entry a task.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np

from quantis.llm.wordbatch import U64, Words, word_hash

#: Distinct words that a task gathers before it hands them on.
FLUSH = 2_000_000


def take_spans(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the spans one after the other, and where each begins."""
    size = end - start
    first = np.concatenate([[0], np.cumsum(size)])
    return data[np.repeat(start - first[:-1], size) + np.arange(first[-1])], first


def packed(values: np.ndarray) -> bytes:
    """Unsigned numbers of up to 64 bits as compressed planes of one byte, as
    many as the largest one needs, which the first byte tells."""
    raw = values.astype("<u8")
    planes = max(1, (int(raw.max(initial=0)).bit_length() + 7) // 8)
    raw = raw.view(np.uint8).reshape(-1, 8)[:, :planes]
    return bytes([planes]) + zlib.compress(np.ascontiguousarray(raw.T).tobytes(), 1)


def unpacked(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(memoryview(raw)[1:]), np.uint8).reshape(raw[0], -1)
    values = np.zeros((planes.shape[1], 8), np.uint8)
    values[:, : raw[0]] = planes.T
    return values.view("<i8").ravel()


class Vocabulary:
    """Distinct words of the slices added so far."""

    def __init__(self) -> None:
        self.hash: list[np.ndarray] = []
        self.count: list[np.ndarray] = []
        self.data: list[np.ndarray] = []
        self.size: list[np.ndarray] = []
        self.held = 0

    def add(self, w: Words, h: np.ndarray, chosen: np.ndarray | None = None) -> None:
        """Adds the words of a slice (those of ``chosen`` positions)."""
        at = np.arange(len(h)) if chosen is None else chosen
        if not len(at):
            return
        u, first, n = np.unique(h[at], return_index=True, return_counts=True)
        data, off = take_spans(w.data, w.start[at][first], w.end[at][first])
        self._push(u, n, data, np.diff(off))

    def _push(self, u: np.ndarray, n: np.ndarray, data: np.ndarray, size: np.ndarray) -> None:
        for kept, new in ((self.hash, u), (self.count, n), (self.data, data), (self.size, size)):
            kept.append(new)
        self.held += len(u)
        if self.held > 2 * FLUSH:
            self._push_again()

    def _push_again(self) -> None:
        u, n, data, off = self.distinct()
        self.__init__()
        self.hash, self.count, self.data, self.size, self.held = [u], [n], [data], [np.diff(off)], len(u)

    @property
    def full(self) -> bool:
        return self.held > FLUSH

    def distinct(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Hashes (ascending), counts, and the words' bytes with offsets."""
        if not self.hash:
            none = np.zeros(0, np.int64)
            return none.astype(U64), none, none.astype(np.uint8), np.zeros(1, np.int64)
        h, n, data, size = (np.concatenate(x) for x in (self.hash, self.count, self.data, self.size))
        u, first, where = np.unique(h, return_index=True, return_inverse=True)
        total = np.zeros(len(u), np.int64)
        np.add.at(total, where, n)
        start = (np.cumsum(size) - size)[first]
        return u, total, *take_spans(data, start, start + size[first])

    def by_bucket(self, buckets: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """For each bucket that has words: bucket, hashes, counts and the
        words joined by a space."""
        u, n, data, off = self.distinct()
        bucket = (u % U64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        u, n, bucket = u[order], n[order], bucket[order]
        # each word with a space after it
        size = np.diff(off)[order] + 1
        body, first = take_spans(np.append(data, np.uint8(0x20)), off[:-1][order], off[:-1][order] + size)
        body[first[1:] - 1] = 0x20
        for a, b in runs(bucket):
            yield int(bucket[a]), u[a:b], n[a:b], body[first[a] : first[b] - 1]


def runs(values: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of equal neighbours."""
    if len(values):
        at = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1], [True]]))
        yield from zip(at[:-1].tolist(), at[1:].tolist(), strict=True)


def summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Total count of each distinct hash."""
    h, n = (np.concatenate(x) for x in zip(*parts, strict=True))
    u, where = np.unique(h, return_inverse=True)
    total = np.zeros(len(u), np.int64)
    np.add.at(total, where, n)
    return u, total


__all__ = ["Vocabulary", "packed", "runs", "summed", "take_spans", "unpacked", "word_hash"]
