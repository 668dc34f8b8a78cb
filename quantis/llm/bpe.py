"""BPE encoding and decoding through a table of distinct words (operator 8).

The tokenizers handled here normalise character by character and never join
pieces across white space, so the encoding of a text is the encodings of its
white-space-separated words one after the other.  Texts are split in Spark
tasks; a *unit* (about ``UNIT_BYTES`` of one task's texts) numbers its
distinct words and keeps every text as a list of word numbers.  The distinct
words of all units meet in buckets by hash, where each is encoded once by the
tokenizers library; the ids go back to the units and replace the word numbers
by position.  A word that a third of all tokens repeat costs one entry a unit.
Texts themselves are never shuffled.

Decoding joins ids with the vocabulary's pieces; the vocabulary has a fixed
size, so it is a table that every worker holds.

The texts are read twice, once for the words and once for the positions.  A
unit is named by its place and a digest of its words: should a second read
give other rows or another order (a frame that is not repeatable), encoding
stops with an error instead of mixing up words.

Defined cases: null and empty texts have no tokens and decode to the empty
text; null ids stay; equal rows get equal results; an empty table gives an
empty result.  Extra columns are not read.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quantis.llm.substring import binary_rows, binary_values
from quantis.llm.units import Unit, units
from quantis.llm.vocabulary import take_spans
from quantis.llm.work import forget, kept, release

#: Bytes of decoded text in an Arrow batch, about.
TEXT_BYTES = 16 << 20
#: Buckets of distinct words: fewest, and texts for each further one.
LEAST_BUCKETS, TEXTS_A_BUCKET = 64, 4_000


@kept
@lru_cache(maxsize=4)
def tokenizer(path: str):
    """The library's tokenizer, one for each worker process."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(path)
    found.no_truncation()
    found.no_padding()
    return found


def check_kind(path: str) -> None:
    """Raises unless words can be encoded one by one."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    steps = lambda x: [] if x is None else x.get("normalizers") or x.get("pretokenizers") or [x]
    normal = {s["type"] for s in steps(spec["normalizer"])}
    split = steps(spec["pre_tokenizer"])
    free = any(s["type"] == "Split" and s["behavior"] == "Removed" and s["invert"] for s in split)
    marks = [t for t in spec["added_tokens"] if t["lstrip"] or t["rstrip"] or any(c.isspace() for c in t["content"])]
    if not normal <= {"NFC", "Replace", "Lowercase"} or not free or marks or spec["decoder"]:
        raise ValueError(f"texts of this tokenizer cannot be encoded word by word: {path}")


def pieces(path: str) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 of every id's piece with a space after it, and where each begins."""
    found = tokenizer(path)
    body = [((found.id_to_token(i) or "") + " ").encode() for i in range(max(found.get_vocab(with_added_tokens=True).values()) + 1)]
    return np.frombuffer(b"".join(body), np.uint8), np.concatenate([[0], np.cumsum([len(b) for b in body])])


def unit_words(u: Unit) -> Iterator[tuple[int, int, bytes]]:
    """For each bucket: bucket, number of its first word, joined words."""
    shift = np.concatenate([[0], np.cumsum([len(w.data) + 1 for _, w in u.slices])])[:-1]
    data = np.concatenate([np.append(w.data, np.uint8(0x20)) for _, w in u.slices])
    start = np.concatenate([w.start + s for (_, w), s in zip(u.slices, shift, strict=True)])[u.first]
    end = np.concatenate([w.end + s for (_, w), s in zip(u.slices, shift, strict=True)])[u.first]
    body, off = take_spans(data, start, end + 1)
    body[off[1:] - 1] = 0x20
    for bucket, a, b in u.by_bucket():
        yield bucket, a, zlib.compress(body[off[a] : off[b] - 1].tobytes(), 1)


def unit_texts(u: Unit) -> Iterator[pa.RecordBatch]:
    """One row for each slice of texts: their ids, their numbers of words, and
    the words' numbers as compressed planes of one byte (three, or four beyond
    2**24 words)."""
    planes = 3 if len(u.first) < 1 << 24 else 4
    at = 0
    for batch, w in u.slices:
        raw = u.word[at : at + len(w.start)].astype("<u4").view(np.uint8).reshape(-1, 4)[:, :planes]
        at += len(w.start)
        ids = batch.column("id").slice(w.row, w.n_docs)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([u.name], pa.binary()), pa.ListArray.from_arrays(pa.array([0, w.n_docs], pa.int32()), ids),
                pa.array([np.diff(w.first).astype("<u4").tobytes()], pa.binary()), pa.array([planes], pa.int32()),
                pa.array([zlib.compress(np.ascontiguousarray(raw.T).tobytes(), 1)], pa.binary()),
            ],
            names=["unit", "ids", "sizes", "planes", "numbers"],
        )


def _distinct(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for u in units(batches, buckets):
            rows = list(unit_words(u))
            yield pa.RecordBatch.from_pydict(
                {
                    "bucket": pa.array([r[0] for r in rows], pa.int32()), "unit": pa.array([u.name] * len(rows), pa.binary()),
                    "first": pa.array([r[1] for r in rows], pa.int32()), "words": pa.array([r[2] for r in rows], pa.binary()),
                }
            )
            del u, rows
            release()

    return run


def _positions(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for u in units(batches, buckets):
            yield from unit_texts(u)
            del u
            release()

    return run


def _encode_words(path: str):
    """Encodes each distinct word of a bucket once; answers every unit."""

    def run(table: pa.Table) -> pa.Table:
        lists = [zlib.decompress(b).decode().split(" ") for b in table["words"].to_pylist()]
        distinct = list(dict.fromkeys(word for words in lists for word in words))
        ids: dict[str, bytes] = {}
        for a in range(0, len(distinct), 50_000):
            part = distinct[a : a + 50_000]
            for word, e in zip(part, tokenizer(path).encode_batch_fast(part, add_special_tokens=False), strict=True):
                ids[word] = np.array(e.ids, "<u4").tobytes()
        sizes, bodies = [], []
        for words in lists:
            found = [ids[word] for word in words]
            sizes.append(zlib.compress(np.array([len(x) // 4 for x in found], "<u4").tobytes(), 1))
            bodies.append(zlib.compress(b"".join(found), 1))
        del ids, lists, distinct
        release()
        return pa.table(
            {"unit": table["unit"], "first": table["first"], "sizes": pa.array(sizes, pa.binary()), "ids": pa.array(bodies, pa.binary())}
        )

    return run


def _replace(pieces=None):
    """Ids of a unit's texts: word numbers replaced by their words' ids.  With
    the vocabulary's pieces the ids are arrays, and the texts they decode to
    come with them."""

    def run(texts: pa.Table, words: pa.Table) -> pa.Table:
        forget()  # the tokenizers of the stage before
        words = words.sort_by("first")
        sizes = [np.frombuffer(zlib.decompress(b), "<u4") for b in words["sizes"].to_pylist()]
        expected = np.cumsum([0] + [len(s) for s in sizes])[:-1]
        size = np.concatenate([np.zeros(0, "<u4"), *sizes]).astype(np.int64)
        ids = np.frombuffer(b"".join(map(zlib.decompress, words["ids"].to_pylist())), "<u4")
        off = np.concatenate([[0], np.cumsum(size)])
        out = []
        for row in range(len(texts)):
            planes = texts["planes"][row].as_py()
            raw = np.frombuffer(zlib.decompress(texts["numbers"][row].as_py()), np.uint8).reshape(planes, -1)
            number = sum(raw[k].astype(np.int64) << (8 * k) for k in range(planes))
            if not np.array_equal(expected, words["first"].to_numpy()) or (len(number) and number.max() >= len(size)):
                raise RuntimeError("the texts were not the same when read again; write them to a table before encoding")
            body, place = take_spans(ids, off[number], off[number + 1])
            ends = np.cumsum(np.frombuffer(texts["sizes"][row].as_py(), "<u4"), dtype=np.int64)
            at = place[np.concatenate([[0], ends])]
            found = {"id": texts["ids"][row].values}
            if pieces is None:
                found["ids"] = binary_rows(body, at)
            else:
                found["ids"] = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(body.astype(np.int32)))
                found["decoded"] = pa.array([text_of(body[a:b], pieces.value) for a, b in zip(at[:-1], at[1:], strict=True)], pa.string())
            out.append(pa.table(found))
        del words, sizes, size, ids, off
        release()
        return pa.concat_tables(out)

    return run


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", packed: bool = False) -> DataFrame:
    """``id_col`` and ``ids`` of each document: an array of int, or if
    ``packed`` little-endian unsigned 32-bit integers as binary."""
    places, answers, kind = _units_and_words(docs, path, id_col, text_col)
    found = places.groupBy("unit").cogroup(answers.groupBy("unit")).applyInArrow(_replace(), f"id {kind}, ids binary")
    if not packed:
        found = found.mapInArrow(_unpack, f"id {kind}, ids array<int>")
    return found.withColumnRenamed("id", id_col)


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``encode`` and ``decode`` in one: ``id_col``, ``ids`` (array of int) and
    ``decoded``.  The worker that puts a unit's ids together decodes them, so a
    task needs one worker where the two need two, and the ids go to Python and
    back once."""
    places, answers, kind = _units_and_words(docs, path, id_col, text_col)
    table = docs.sparkSession.sparkContext.broadcast(pieces(path))
    found = places.groupBy("unit").cogroup(answers.groupBy("unit")).applyInArrow(_replace(table), f"id {kind}, ids array<int>, decoded string")
    return found.withColumnRenamed("id", id_col)


def _units_and_words(docs: DataFrame, path: str, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame, str]:
    """Texts of each unit as word numbers, the ids of its words, and the type
    of the texts' ids."""
    check_kind(path)
    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()
    buckets = max(LEAST_BUCKETS, narrow.count() // TEXTS_A_BUCKET)
    asked = narrow.mapInArrow(_distinct(buckets), "bucket int, unit binary, first int, words binary")
    answers = asked.groupBy("bucket").applyInArrow(_encode_words(path), "unit binary, first int, sizes binary, ids binary")
    places = narrow.mapInArrow(_positions(buckets), f"unit binary, ids array<{kind}>, sizes binary, planes int, numbers binary")
    return places, answers, kind


def text_of(ids: np.ndarray, pieces: tuple[np.ndarray, np.ndarray]) -> str:
    """Pieces of the ids, joined by a space."""
    data, off = pieces
    return take_spans(data, off[ids], off[ids + 1])[0][:-1].tobytes().decode()


def _unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values, n = binary_values(batch.column("ids"), "<u4")
        ids = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32()), pa.array(values.astype(np.int32)))
        yield pa.RecordBatch.from_arrays([*batch.columns[:1], ids, *batch.columns[2:]], names=batch.schema.names)


def _decode(table):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            step = max(1, len(whole) * TEXT_BYTES // (1 + 4 * whole.column("ids").nbytes))
            for a in range(0, len(whole), step):  # decoded texts are several times as long
                batch, out = whole.slice(a, step), []
                for x in batch.column("ids"):
                    raw = x.as_py()
                    ids = np.frombuffer(raw, "<u4") if isinstance(raw, bytes) else np.array(raw or [], np.int64)
                    out.append(text_of(ids, table.value))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.string())], names=[*batch.schema.names, "decoded"])
        release()

    return run


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """Adds ``decoded``, the pieces of the column ``ids`` joined by a space
    (these tokenizers have no decoder of their own).  The vocabulary's pieces
    (about a megabyte) are broadcast; workers need no tokenizer."""
    table = encoded.sparkSession.sparkContext.broadcast(pieces(path))
    kinds = {f.name: f.dataType.simpleString() for f in encoded.schema.fields}
    schema = ", ".join(f"`{name}` {kind}" for name, kind in kinds.items())
    return encoded.mapInArrow(_decode(table), f"{schema}, decoded string")


def encoded_rows(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, source, ``ids`` (array of int), ``n_tokens`` and ``decoded`` of
    each document."""
    named = docs.select(F.struct("doc_id", "source").alias("row"), F.col("text").alias("text"))
    out = round_trip(named, path, "row", "text")
    return out.select("row.doc_id", "row.source", "ids", F.size("ids").cast("long").alias("n_tokens"), "decoded")
