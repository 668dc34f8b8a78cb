"""Alignment of two tokenizers' tokens (operator 12).

Both tokenizers encode the same bytes, a space and the text.  A token's bytes
are a row of its tokenizer's *token-byte incidence matrix*; the matrices are
kept as compressed sparse rows built here by hand (``Csr``).

* Overlap links: the product A * B^T by Gustavson's algorithm, row by row: the
  rows of B^T that a token's bytes select are added up.  An entry is a link and
  its value the number of shared bytes.
* Shared-group links: byte offsets where tokens of both end cut the tokens into
  groups; the product of the token-group incidence matrices links all tokens of
  a group.  Its entries can be many, so they are made row block by row block
  and only on demand; their number comes from the row sizes alone.

Neither tokenizer joins what stands before a space to the space and what
follows it (checked for the files at hand; other files are taken text by
text).  So a text falls into *chunks*, a space and what follows up to the next
such space, and the matrices are block diagonal: every distinct chunk of a
*unit* (texts of one task, about ``UNIT_BYTES``) is encoded and aligned once,
and the unit's document-by-chunk matrix times its chunk-by-pair matrix, again
by Gustavson's algorithm, is its document-by-pair matrix.

A unit is written as one row of a table in the shared folder: its documents'
figures, its distinct linked id pairs with the number of its documents that
hold each, and the document-by-pair matrix.  Spark sums the pairs' document counts
over the units, takes every A id's highest one (the vocabulary bounds their
number, so they are broadcast), and joins both back to the units' pairs; a
unit's matrix times these counts gives the sums of its documents.

Defined cases: null and empty texts, and texts whose tokens do not spell the
space and the text, have no tokens, no groups and an empty digest; null ids
stay; equal rows count as several documents and get equal results; an empty
table gives an empty result.  Only the id and the text are read.
"""

from __future__ import annotations

import hashlib
import json
import os
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from quantis.llm.tokencount import byte_symbols
from quantis.llm.vocabulary import take_spans
from quantis.llm.wordbatch import slices, texts, utf8
from quantis.llm.work import bounded_batches, kept, release, stored

UNIT_BYTES, SLICE_BYTES = 8 << 20, 1 << 20
#: Products that a block of rows makes at a time.
BLOCK = 1 << 20


@dataclass
class Csr:
    """Sparse matrix by rows: row i holds the columns
    ``indices[first[i]:first[i + 1]]`` with their values."""

    first: np.ndarray
    indices: np.ndarray
    values: np.ndarray
    columns: int

    @property
    def rows(self) -> int:
        return len(self.first) - 1

    def transposed(self) -> Csr:
        order = np.argsort(self.indices, kind="stable")
        first = np.concatenate([[0], np.cumsum(np.bincount(self.indices, minlength=self.columns))])
        row = np.repeat(np.arange(self.rows), np.diff(self.first))
        return Csr(first, row[order], self.values[order], self.rows)

    def product_sizes(self, other: Csr) -> np.ndarray:
        """Products that each row of ``self * other`` adds up."""
        made = np.concatenate([[0], np.cumsum(np.diff(other.first)[self.indices])])
        return np.diff(made[self.first])

    def product(self, other: Csr, block: int = BLOCK) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Row, column and value of the entries of ``self * other``, in blocks
        of rows that make about ``block`` products."""
        done = np.concatenate([[0], np.cumsum(self.product_sizes(other))])
        cuts = np.unique(np.concatenate([[0], np.searchsorted(done, np.arange(block, done[-1], block)), [self.rows]]))
        size = np.diff(other.first)
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            held = slice(self.first[a], self.first[b])
            picked = self.indices[held]
            n = size[picked]
            at = np.cumsum(n) - n
            place = np.arange(int(n.sum())) + np.repeat(other.first[picked] - at, n)
            row = np.repeat(np.repeat(np.arange(a, b), np.diff(self.first[a : b + 1])), n)
            column, value = other.indices[place], np.repeat(self.values[held], n) * other.values[place]
            key = row * other.columns + column
            if len(key) and (np.diff(key) < 0).any():
                order = np.argsort(key, kind="stable")
                key, row, column, value = key[order], row[order], column[order], value[order]
            new = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, int)
            yield row[new], column[new], np.add.reduceat(value, new) if len(new) else value


def incidence(ends: np.ndarray) -> Csr:
    """Token-byte matrix of tokens that end at these offsets."""
    n = int(ends[-1]) if len(ends) else 0
    return Csr(np.concatenate([[0], ends]).astype(np.int64), np.arange(n), np.ones(n, np.int64), n)


def group_incidence(group: np.ndarray, groups: int) -> Csr:
    return Csr(np.arange(len(group) + 1), group, np.ones(len(group), np.int64), groups)


@dataclass
class Aligned:
    """Tokens of a run of documents over the same bytes: ids and end offsets of
    both sides, and the group of each token."""

    a: np.ndarray
    b: np.ndarray
    a_end: np.ndarray
    b_end: np.ndarray
    common: np.ndarray  # offsets where tokens of both sides end

    @property
    def a_group(self) -> np.ndarray:
        return np.searchsorted(self.common, self.a_end)

    @property
    def b_group(self) -> np.ndarray:
        return np.searchsorted(self.common, self.b_end)

    def links(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Positions of overlapping tokens, and the bytes that they share."""
        return incidence(self.a_end).product(incidence(self.b_end).transposed())

    def shared(self) -> tuple[Csr, Csr]:
        """Factors of the shared-group product."""
        n = len(self.common)
        return group_incidence(self.a_group, n), group_incidence(self.b_group, n).transposed()


def aligned(a: np.ndarray, b: np.ndarray, a_size: np.ndarray, b_size: np.ndarray) -> Aligned:
    a_end, b_end = np.cumsum(a_size), np.cumsum(b_size)
    return Aligned(a, b, a_end, b_end, np.intersect1d(a_end, b_end, assume_unique=True))


class Spelling:
    """Bytes of every id of a vocabulary."""

    def __init__(self, spelled: list[bytes]):
        self.data = np.frombuffer(b"".join(spelled), np.uint8)
        self.size = np.array([len(x) for x in spelled], np.int64)
        self.first = np.cumsum(self.size) - self.size

    def of(self, ids: np.ndarray) -> np.ndarray:
        return take_spans(self.data, self.first[ids], self.first[ids] + self.size[ids])[0]


@kept
@lru_cache(maxsize=4)
def byte_level(path: str):
    """Encoder and spelling of a byte-level vocabulary (tokenizers)."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(path)
    found.no_truncation()
    found.no_padding()
    found.encode_special_tokens = True
    byte = byte_symbols()
    pieces = [found.id_to_token(i) or "" for i in range(max(found.get_vocab().values()) + 1)]
    spelling = Spelling([bytes(byte[c] for c in p) for p in pieces])

    def encode(texts: list[str]) -> list[list[int]]:
        return [e.ids for e in found.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]

    return encode, spelling


@kept
@lru_cache(maxsize=4)
def piece_level(path: str):
    """Encoder and spelling of a vocabulary of pieces (sentencepiece)."""
    import sentencepiece

    found = sentencepiece.SentencePieceProcessor(model_file=path)
    size = found.get_piece_size()
    spelled = [
        bytes([int(p[3:5], 16)]) if found.is_byte(i) else p.replace("▁", " ").encode()
        for i, p in ((i, found.id_to_piece(i)) for i in range(size))
    ]

    def encode(texts: list[str]) -> list[list[int]]:
        return found.encode(texts, num_threads=1)

    return encode, Spelling(spelled)


def flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """All ids one after the other, and where each list begins."""
    first = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int64)
    return np.fromiter(chain.from_iterable(lists), np.int64, int(first[-1])), first


def spells(ids: np.ndarray, first: np.ndarray, spelling: Spelling, data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Whether each list of ids spells its bytes."""
    size = np.concatenate([[0], np.cumsum(spelling.size[ids])])
    good = np.diff(size[first]) == np.diff(off)
    some = np.flatnonzero(good)
    made = spelling.of(ids[np.repeat(good, np.diff(first))])
    there, begin = take_spans(data, off[some], off[some + 1])
    wrong = np.concatenate([[0], np.cumsum(made != there)])
    good[some] = wrong[begin[1:]] == wrong[begin[:-1]]
    return good


#: Decimal digits of every number that a token id can be, with one place for what follows.
@lru_cache(maxsize=1)
def _decimals(n: int) -> tuple[np.ndarray, np.ndarray]:
    body = [b"%d " % i for i in range(n)]
    return np.frombuffer(b"".join(body), np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in body])])


def group_texts(x: Aligned, a_first: np.ndarray, b_first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``a1,a2|b1;a3|b2,b3;`` of each range of tokens (``a_first``,
    ``b_first``), one after the other, and where each begins."""
    ga, gb = x.a_group, x.b_group
    # A's tokens of a group stand before B's
    a_at = np.arange(len(ga)) + np.searchsorted(gb, ga, side="left")
    b_at = np.arange(len(gb)) + np.searchsorted(ga, gb, side="right")
    ids, after = np.empty(len(ga) + len(gb), np.int64), np.full(len(ga) + len(gb), ord(","), np.uint8)
    ids[a_at], ids[b_at] = x.a, x.b
    after[a_at[np.append(ga[1:] != ga[:-1], True)]] = ord("|")
    after[b_at[np.append(gb[1:] != gb[:-1], True)]] = ord(";")
    data, off = _decimals(1 << 17)
    body, first = take_spans(data, off[ids], off[ids + 1])
    body[first[1:] - 1] = after
    return body, first[a_first + b_first]


DOC = [("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()), ("n_shared", pa.int64()), ("groups_sha256", pa.string())]


# Bytes that can begin a character that is no white space after
# a space.  Left out are white space, and lead bytes under which Unicode has
# some (it is enough that no cut is made there).
FOLLOWS = np.zeros(256, bool)
FOLLOWS[0x21:0x7F] = True
FOLLOWS[0xC3:0xF5] = True
FOLLOWS[[0xE1, 0xE2, 0xE3]] = False


@lru_cache(maxsize=4)
def cuts_at_spaces(path_a: str, path_b: str) -> bool:
    """Whether both tokenizers can be applied chunk by chunk: byte-level BPE
    with the usual pre-split, which joins one space to what follows it, and
    pieces without a space inside, over unchanged text."""
    import sentencepiece

    with open(path_a, encoding="utf-8") as f:
        spec = json.load(f)
    parts = spec["pre_tokenizer"] or {}
    usual = parts.get("type") == "ByteLevel" and parts.get("use_regex", True) and not parts["add_prefix_space"]
    found = sentencepiece.SentencePieceProcessor(model_file=path_b)
    pieces = [found.id_to_piece(i).lstrip("▁") for i in range(found.get_piece_size())]
    kept = [found.id_to_piece(i) for i in found.encode(" a  b c ")]
    whole = "".join(kept) == "▁▁a▁▁b▁c▁"  # a space before the text, and every space of it
    return usual and not spec.get("normalizer") and whole and not any("▁" in p for p in pieces)


@dataclass
class Chunks:
    """Chunks of a run of texts, without the space that each begins with."""

    body: pa.LargeBinaryArray  # distinct ones
    number: np.ndarray  # of each place
    first: np.ndarray  # range of places of each text


def chunks(runs: list[tuple[np.ndarray, np.ndarray]], cut: bool) -> Chunks:
    """Chunks of texts given as runs of bytes and offsets; an empty text has
    none."""
    bodies, counts = [], []
    for data, off in runs:
        start_of = np.zeros(len(data) + 1, bool)
        if cut and len(data) > 2:
            at = np.flatnonzero((data[1:-1] == 0x20) & (data[:-2] != 0x20) & FOLLOWS[data[2:]]) + 1
            start_of[at + 1] = True
            # a space that ends or begins its text cuts nothing
            edge = np.concatenate([off[:-1], off[:-1] + 1])
            start_of[edge[edge <= len(data)]] = False
        start_of[off[:-1][np.diff(off) > 0]] = True
        start = np.flatnonzero(start_of[:-1])
        doc = np.searchsorted(off, start, side="right") - 1
        last = np.append(doc[1:] != doc[:-1], True) if len(doc) else np.zeros(0, bool)
        end = np.where(last, off[doc + 1], np.append(start[1:], 0) - 1)
        body, at = take_spans(data, start, end)
        bodies.append(pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(body)]))
        counts.append(np.bincount(doc, minlength=len(off) - 1))
    found = pa.chunked_array(bodies, pa.large_binary()).dictionary_encode().combine_chunks()
    number = found.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    return Chunks(found.dictionary, number, np.concatenate([[0], *counts]).cumsum().astype(np.int64))


class Unit:
    """Tokens of the distinct chunks of a run of texts, and the texts as lists
    of chunks.  Texts of which a chunk is not spelled by its tokens have none."""

    def __init__(self, runs: list[tuple[np.ndarray, np.ndarray]], path_a: str, path_b: str):
        (encode_a, spell_a), (encode_b, spell_b) = byte_level(path_a), piece_level(path_b)
        c = chunks(runs, cuts_at_spaces(path_a, path_b))
        raw = c.body.to_pylist()
        spelled = [x.decode() for x in raw]
        (a, a_first), (b, b_first) = flat(encode_a(spelled)), flat(encode_b(spelled))
        raw = [b" " + x for x in raw]
        data, off = np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
        good = spells(a, a_first, spell_a, data, off) & spells(b, b_first, spell_b, data, off)
        fine = np.diff(np.concatenate([[0], np.cumsum(good[c.number])])[c.first]) == np.diff(c.first)
        self.number = c.number[np.repeat(fine, np.diff(c.first))]
        self.first = np.concatenate([[0], np.cumsum(np.where(fine, np.diff(c.first), 0))])
        # chunks that are not spelled stand in no text that is left
        a, b = a[np.repeat(good, np.diff(a_first))], b[np.repeat(good, np.diff(b_first))]
        self.n_a, self.n_b = np.where(good, np.diff(a_first), 0), np.where(good, np.diff(b_first), 0)
        self.a_first, self.b_first = np.concatenate([[0], np.cumsum(self.n_a)]), np.concatenate([[0], np.cumsum(self.n_b)])
        self.a_size, self.b_size = spell_a.size[a], spell_b.size[b]
        self.chunk = aligned(a, b, self.a_size, self.b_size)

    @property
    def n_docs(self) -> int:
        return len(self.first) - 1

    def total(self, per_chunk: np.ndarray) -> np.ndarray:
        """Sum of a figure of chunks for each text."""
        return np.diff(np.concatenate([[0], np.cumsum(per_chunk[self.number])])[self.first])

    def whole(self) -> tuple[Aligned, np.ndarray, np.ndarray]:
        """Alignment of the whole texts, and their token ranges."""
        a_at, a_first = take_spans(np.arange(len(self.chunk.a)), self.a_first[self.number], self.a_first[self.number + 1])
        b_at, b_first = take_spans(np.arange(len(self.chunk.b)), self.b_first[self.number], self.b_first[self.number + 1])
        x = aligned(self.chunk.a[a_at], self.chunk.b[b_at], self.a_size[a_at], self.b_size[b_at])
        return x, a_first[self.first], b_first[self.first]

    def chunk_pairs(self) -> tuple[np.ndarray, Csr, np.ndarray]:
        """Distinct id pairs, the chunk-by-pair matrix of their numbers of
        links, and the number of links of each chunk."""
        x = self.chunk
        found = [(i, j) for i, j, _ in x.links()]
        i, j = (np.concatenate([f[k] for f in found]) if found else np.zeros(0, np.int64) for k in (0, 1))
        chunk = np.searchsorted(self.a_first, i, side="right") - 1
        names, column = np.unique((x.a[i] << 32) + x.b[j], return_inverse=True)
        n = np.bincount(chunk, minlength=len(self.n_a))
        return names, Csr(np.concatenate([[0], np.cumsum(n)]), column, np.ones(len(column), np.int64), len(names)), n

    def figures(self, n_links: np.ndarray) -> dict[str, np.ndarray | list[str]]:
        """Columns of ``DOC`` for all texts."""
        x = self.chunk
        ends = np.concatenate([[0], x.a_end])[self.a_first]
        n_groups = np.diff(np.searchsorted(x.common, ends, side="right"))
        left, right = x.shared()
        shared = np.diff(np.concatenate([[0], np.cumsum(left.product_sizes(right))])[self.a_first])
        per = {"n_a": self.n_a, "n_b": self.n_b, "n_groups": n_groups, "n_links": n_links, "n_shared": shared}
        out: dict[str, np.ndarray | list[str]] = {c: self.total(v) for c, v in per.items()}
        data, off = group_texts(x, self.a_first, self.b_first)
        digest = []
        for p, q in zip(self.first[:-1].tolist(), self.first[1:].tolist(), strict=True):
            of = self.number[p:q]
            body = take_spans(data, off[of], off[of + 1])[0]
            digest.append(hashlib.sha256(body[:-1]).hexdigest() if q > p else "")
        return out | {"groups_sha256": digest}


def runs_of(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[tuple[pa.Array, list[tuple[np.ndarray, np.ndarray]]]]:
    """Ids and UTF-8 of texts in runs of about ``limit`` bytes."""
    ids, held, size = [], [], 0
    for batch in batches:
        data, off = utf8(texts(batch.column("text")))
        for a, b in slices(off, SLICE_BYTES):
            ids.append(batch.column("id").slice(a, b - a))
            held.append((data[off[a] : off[b]], off[a : b + 1] - off[a]))
            size += int(off[b] - off[a])
            if size >= limit:
                yield pa.concat_arrays(ids), held
                ids, held, size = [], [], 0
    if ids:
        yield pa.concat_arrays(ids), held


def planes(values: np.ndarray) -> bytes:
    """Unsigned numbers as compressed planes of one byte."""
    raw = values.astype("<u4").view(np.uint8).reshape(-1, 4)
    return zlib.compress(np.ascontiguousarray(raw.T).tobytes(), 1)


def from_planes(raw: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(zlib.decompress(raw), np.uint8).reshape(4, -1).T).view("<u4").ravel().astype(np.int64)


def _units(path_a: str, path_b: str):
    """One row for each unit: its documents' figures, its id pairs with their
    document counts, and its document-by-pair matrix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, held in runs_of(batches, UNIT_BYTES):
            u = Unit(held, path_a, path_b)
            names, chunk_pairs, n_links = u.chunk_pairs()
            docs = Csr(u.first, u.number, np.ones(len(u.number), np.int64), len(n_links))
            found = list(docs.product(chunk_pairs))
            doc, pair, times = (np.concatenate([f[k] for f in found]) if found else np.zeros(0, np.int64) for k in range(3))
            figures = u.figures(n_links)
            columns = [pa.array(figures[c], t) for c, t in DOC]
            struct = pa.StructArray.from_arrays([ids, *columns], fields=[pa.field("id", ids.type), *(pa.field(c, t) for c, t in DOC)])
            whole = lambda x: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([uuid.uuid4().hex]), whole(struct), whole(pa.array(names, pa.int64())),
                    whole(pa.array(np.bincount(pair, minlength=len(names)), pa.int32())),
                    pa.array([planes(np.bincount(doc, minlength=u.n_docs))], pa.binary()), pa.array([planes(pair)], pa.binary()),
                    pa.array([planes(times)], pa.binary()),
                ],
                names=["unit", "docs", "pairs", "held", "cells", "columns", "times"],
            )
            del u, docs, found, doc, pair, times, figures, columns, struct, held, ids
            release()

    return run


def _multiplied(kind: pa.DataType):
    """A unit's documents with the sums over their links."""
    schema = pa.schema([("id", kind), *DOC, ("n_best", pa.int64()), ("count_sum", pa.int64())])

    def run(unit: pa.Table, answers: pa.Table) -> pa.Table:
        if not len(unit):
            return schema.empty_table()
        count = np.zeros(len(unit["pairs"][0]), np.int64)
        best = np.zeros(len(count), np.int64)
        at = answers["place"].to_numpy()
        count[at], best[at] = answers["count"].to_numpy(), answers["best"].to_numpy().astype(np.int64)
        cells, columns, times = (from_planes(unit[c][0].as_py()) for c in ("cells", "columns", "times"))
        first = np.concatenate([[0], np.cumsum(cells)])
        total = lambda x: np.diff(np.concatenate([[0], np.cumsum(times * x[columns])])[first])
        docs = unit["docs"].combine_chunks().flatten()
        return pa.table(
            [*docs.flatten(), pa.array(total(best)), pa.array(total(count))], names=[f.name for f in docs.type] + ["n_best", "count_sum"]
        ).cast(schema)

    return run


def report(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For each document: ``id_col``, ``n_a``, ``n_b``, ``n_groups``,
    ``n_links``, ``n_shared`` (pairs of tokens in one group), ``groups_sha256``,
    ``n_best`` and ``count_sum``.  The files must be readable everywhere."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()
    struct = f"id:{kind}," + ",".join(f"{c}:{'string' if t == pa.string() else 'bigint'}" for c, t in DOC)
    with bounded_batches(docs.sparkSession):
        units = stored(
            rows.mapInArrow(
                _units(path_a, path_b),
                f"unit string, docs array<struct<{struct}>>, pairs array<bigint>, held array<int>, cells binary, columns binary, times binary",
            )
        )
    asked = units.select("unit", F.posexplode(F.arrays_zip("pairs", "held")).alias("place", "of"))
    asked = asked.select("unit", "place", F.col("of.pairs").alias("pair"), F.col("of.held").alias("held"))
    counts = stored(asked.groupBy("pair").agg(F.sum("held").alias("count")))
    a_id = F.shiftright("pair", 32)
    tops = counts.groupBy(a_id.alias("a")).agg(F.max("count").alias("top"))
    # one row for each A id at most: the vocabulary bounds the broadcast
    answers = (
        asked.select("unit", "place", "pair").join(counts, "pair").withColumn("a", a_id).join(F.broadcast(tops), "a")
        .select(F.col("unit").alias("of"), "place", "count", (F.col("count") == F.col("top")).alias("best"))
    )
    field = units.schema["docs"].dataType.elementType["id"].dataType
    columns = f"id {kind}, " + ", ".join(f"{c} {'string' if t == pa.string() else 'long'}" for c, t in DOC)
    out = (
        units.select("unit", "docs", "pairs", "cells", "columns", "times").groupBy("unit").cogroup(answers.groupBy("of"))
        .applyInArrow(_multiplied(to_arrow_type(field)), f"{columns}, n_best long, count_sum long")
    )
    return out.withColumnRenamed("id", id_col)


def _links(path_a: str, path_b: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, held in runs_of(batches, SLICE_BYTES):
            x, a_first, b_first = Unit(held, path_a, path_b).whole()
            for i, j, n in x.links():
                doc = np.searchsorted(a_first, i, side="right") - 1
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(pa.array(doc)), pa.array(i - a_first[doc], pa.int32()), pa.array(j - b_first[doc], pa.int32()),
                        pa.array(x.a[i], pa.int32()), pa.array(x.b[j], pa.int32()), pa.array(n, pa.int32()),
                    ],
                    names=["id", "a_place", "b_place", "a", "b", "bytes"],
                )

    return run


def links(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every overlap link: ``id_col``, places of both tokens in the document,
    their ids, and the ``bytes`` that they share."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, a_place int, b_place int, a int, b int, bytes int"
    return rows.mapInArrow(_links(path_a, path_b), schema).withColumnRenamed("id", id_col)


def _shared(path_a: str, path_b: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, held in runs_of(batches, SLICE_BYTES):
            x, a_first, b_first = Unit(held, path_a, path_b).whole()
            left, right = x.shared()
            for i, j, _ in left.product(right):
                doc = np.searchsorted(a_first, i, side="right") - 1
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(doc)), pa.array(i - a_first[doc], pa.int32()), pa.array(j - b_first[doc], pa.int32())],
                    names=["id", "a_place", "b_place"],
                )

    return run


def shared_links(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every pair of tokens in one group: ``id_col`` and both places."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(_shared(path_a, path_b), f"id {kind}, a_place int, b_place int").withColumnRenamed("id", id_col)
