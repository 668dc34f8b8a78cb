"""Units: runs of one task's texts with numbered distinct words.

A unit is named by its place (task and position) and a digest of its texts,
so that a second pass over the same table makes the same units, and one over
other rows makes units of other names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext

from quantis.llm.vocabulary import take_spans
from quantis.llm.wordbatch import U64, Words, split_words, texts, utf8, word_hash

UNIT_BYTES = 8 << 20


class Unit:
    """Texts of one task, about ``UNIT_BYTES`` long, with their distinct words
    numbered by bucket and hash."""

    def __init__(self, name: bytes, slices: list[tuple[pa.RecordBatch, Words]], buckets: int):
        self.slices = slices
        h = np.concatenate([word_hash(w) for _, w in slices])
        self.name = name + digest(slices)
        where = numbered(slices)
        first = np.empty(int(where.max()) + 1 if len(where) else 0, np.int64)
        first[where[::-1]] = np.arange(len(where))[::-1]
        u = h[first]
        bucket = (u % U64(buckets)).astype(np.int64)
        order = np.lexsort((u, bucket))
        self.hash, self.bucket, self.first = u[order], bucket[order], first[order]
        number = np.empty(len(u), np.int32)
        number[order] = np.arange(len(u), dtype=np.int32)
        self.word = number[where]

    def by_bucket(self) -> Iterator[tuple[int, int, int]]:
        """Bucket, and the range of its words' numbers."""
        if len(self.bucket):
            cut = np.flatnonzero(np.concatenate([[True], self.bucket[1:] != self.bucket[:-1], [True]]))
            for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
                yield int(self.bucket[a]), a, b


def numbered(slices: list[tuple[pa.RecordBatch, Words]]) -> np.ndarray:
    """Number of each word among the distinct ones, told apart by their bytes."""
    parts = []
    for _, w in slices:
        body, at = take_spans(w.data, w.start, w.end)
        parts.append(pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(w.start), [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(body)]))
    words = pa.chunked_array(parts, pa.large_binary()).dictionary_encode().combine_chunks()
    return words.indices.to_numpy(zero_copy_only=False).astype(np.int64)


def named(batches: Iterator[pa.RecordBatch], lower: bool = False) -> Iterator[tuple[bytes, list[tuple[pa.RecordBatch, Words]]]]:
    """Place in the task and texts of each unit (column ``text``).  A unit ends
    with the text that fills it, whatever batches the texts come in."""
    context = TaskContext.get()
    held, size, n = [], 0, 0
    for batch in batches:
        off, a = utf8(texts(batch.column("text")))[1], 0
        while a < len(batch):
            b = min(max(a + 1, int(np.searchsorted(off, off[a] + UNIT_BYTES - size))), len(batch))
            part = batch.slice(a, b - a)
            held.extend((part, w) for w in split_words(part.column("text"), lower))
            size += int(off[b] - off[a])
            a = b
            if size >= UNIT_BYTES:
                yield f"{context.partitionId() if context else 0}-{n}-".encode(), held
                held, size, n = [], 0, n + 1
    if held:
        yield f"{context.partitionId() if context else 0}-{n}-".encode(), held


def digest(slices: list[tuple[pa.RecordBatch, Words]]) -> bytes:
    """Of the texts of a unit and their sizes, wherever its slices end, as in
    its name."""
    data, sizes = hashlib.md5(), hashlib.md5()
    for _, w in slices:
        data.update(w.data)
        sizes.update(np.diff(w.offsets).tobytes())
    return hashlib.md5(data.digest() + sizes.digest()).digest()


def units(batches: Iterator[pa.RecordBatch], buckets: int, lower: bool = False) -> Iterator[Unit]:
    """Units of a task's texts (column ``text``)."""
    for name, slices in named(batches, lower):
        unit = Unit(name, slices, buckets)
        del slices
        yield unit
        del unit  # not held while the next one is read
