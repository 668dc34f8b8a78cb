"""Token counts by heap-and-linked-list byte-pair merging (operator 10).

A piece of the tokenizer's pre-split starts as a linked list of single-byte
symbols.  A heap holds the adjacent pairs that the vocabulary can merge, by
rank and then position; the least is popped, its two symbols become one, and
the pairs with the new neighbours are pushed.  Popped pairs whose symbols have
changed meanwhile are skipped.  The count of a piece is its number of bytes
minus the number of merges: no identifier is emitted.

A piece's count depends on its bytes alone, so each worker remembers the
counts of short pieces (bounded by ``REMEMBERED``) from task to task; longer
pieces are merged where they stand.

Special tokens written out in a text count as one token, as the tokenizer
file says; the text is split at them first.

Defined cases: null and empty texts count 0 bytes and 0 tokens; a null id
stays null; equal rows get equal counts; an empty table gives an empty
result.  Only the id and the text are read.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quantis.llm.wordbatch import texts, utf8
from quantis.llm.work import kept

# The pre-split of byte-level BPE tokenizers.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Pieces whose count a worker remembers, and the longest of them (in
#: characters): at most about 200 MB.
REMEMBERED, LONGEST = 1_000_000, 24


def byte_symbols() -> dict[str, int]:
    """The visible character by which byte-level vocabularies write each byte:
    printable ones stand for themselves, the others for 256, 257, ..."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Counts(dict):
    """Counts of pieces; one that is not there is merged, and remembered if
    it is short."""

    def __init__(self, merge):
        super().__init__()
        self.merge = merge

    def __missing__(self, piece: str) -> int:
        n = self.merge(piece.encode())
        if len(piece) <= LONGEST:
            if len(self) >= REMEMBERED:
                self.clear()
            self[piece] = n
        return n


class Merges:
    """Merge ranks of a tokenizer file, over symbol numbers.

    Symbols 0-255 are the bytes; every merge has a symbol for its result, the
    same one if another merge spells the same bytes."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        parts = spec["pre_tokenizer"]
        if spec["model"]["type"] != "BPE" or parts["type"] != "ByteLevel" or spec.get("normalizer"):
            raise ValueError(f"not a byte-level BPE tokenizer: {path}")
        number = byte_symbols()
        self.rank: dict[tuple[int, int], tuple[int, int]] = {}
        for i, merge in enumerate(spec["model"]["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            made = number.setdefault(left + right, len(number))
            self.rank[(number[left], number[right])] = (i, made)
        special = [t["content"] for t in spec["added_tokens"]]
        self.special = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.pieces = regex.compile(PIECES)
        self.known = Counts(self.count_piece)

    def count_piece(self, piece: bytes) -> int:
        """Symbols left when no adjacent pair can be merged."""
        n = len(piece)
        if n < 2:
            return n
        rank = self.rank
        symbol = list(piece)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []
        for i in range(n - 1):
            found = rank.get((symbol[i], symbol[i + 1]))
            if found:
                heap.append((found[0], i, symbol[i], symbol[i + 1], found[1]))
        heapify(heap)
        merges = 0
        while heap:
            _, i, left, right, made = heappop(heap)
            j = after[i]
            if symbol[i] != left or j >= n or symbol[j] != right:
                continue
            symbol[i], symbol[j] = made, -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            merges += 1
            k = before[i]
            if k >= 0 and (found := rank.get((symbol[k], made))):
                heappush(heap, (found[0], k, symbol[k], made, found[1]))
            k = after[i]
            if k < n and (found := rank.get((made, symbol[k]))):
                heappush(heap, (found[0], i, made, symbol[k], found[1]))
        return n - merges

    def count_plain(self, text: str) -> int:
        return sum(map(self.known.__getitem__, self.pieces.findall(text)))

    def count(self, text: str) -> int:
        """Tokens of a whole text."""
        if self.special is None:
            return self.count_plain(text)
        total, at = 0, 0
        for m in self.special.finditer(text):
            total += self.count_plain(text[at : m.start()]) + 1
            at = m.end()
        return total + self.count_plain(text[at:] if at else text)


@kept
@lru_cache(maxsize=4)
def merges(path: str) -> Merges:
    """One table for each worker process and tokenizer file."""
    return Merges(path)


def _count(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = merges(path).count
        for batch in batches:
            column = texts(batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"), pa.array(np.diff(utf8(column)[1]), pa.int64()),
                    pa.array([count(t.as_py()) for t in column], pa.int64()),
                ],
                names=["id", "n_bytes", "n_tokens"],
            )

    return run


def count_tokens(docs: DataFrame, tokenizer: str, limit: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For each document: ``id_col``, ``n_bytes``, ``n_tokens`` and
    ``over_limit``.  ``tokenizer`` is a file that every executor can read."""
    kind = docs.schema[id_col].dataType.simpleString()
    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    counted = narrow.mapInArrow(_count(tokenizer), f"id {kind}, n_bytes long, n_tokens long")
    return counted.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
