"""Substring deduplication with a count-min prefilter (operator 1).

A window is ``window`` consecutive words of one document.  A word is removed
when a window that covers it starts, with the same words, anywhere else.

Pass 1 builds count-min sketches of window counts.  A window is counted
through its *anchor*, the run of ``anchor`` words inside it with the least
hash.  The anchor depends on the window's words alone, so equal windows have
equal anchors and an anchor occurs at least as often as any window that
carries it; neighbouring windows mostly share theirs, which makes about nine
times fewer entries than windows.  Every partition sketches its own texts,
and the partition sketches are merged cell block by cell block, in streams.
Counts saturate at two: more is not asked for.  A merged sketch has a fixed
size (``DEPTH * WIDTH`` bits, 32 MB), whatever the input; on inputs far beyond
its width it overestimates more and pass 2 has more windows to group, none is
ever lost.

Pass 2 looks every window up.  Those estimated to occur once are done.  Of
the others, each Arrow batch groups its own windows exactly and sends one
entry for each distinct window to the bucket of its anchor, so a window that
a third of all documents hold costs one entry a batch.  Buckets group the
entries exactly, by 128 bits (the anchor's hash and the window's own), and
answer with ranges of repeated windows for each document.

Defined cases: null and empty texts have no words; documents with fewer words
than a window keep all; equal rows (with the same id, or a null id) count as
several places and get the same result; an empty table gives an empty result.
Only the id and the text are read, so other columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quantis.llm.wordbatch import U64, Words, inside, mix, run_hash, split_words, word_hash

DEPTH = 2
WIDTH = 1 << 27
BLOCK = 1 << 21
#: Anchors that a task gathers before it hands on a partial sketch.
FLUSH = 4_000_000
#: Anchors of the corpus for each bucket of the exact pass, and fewest buckets.
ANCHORS_A_BUCKET, LEAST_BUCKETS = 20_000, 128


def sliding(op: np.ufunc, a: np.ndarray, n: int) -> np.ndarray:
    """``op`` over every ``n`` neighbours, by doubling."""
    size = 1
    while size < n:
        step = min(size, n - size)
        a = op(a[: len(a) - step], a[step:])
        size += step
    return a


def window_anchors(h: np.ndarray, first: np.ndarray, window: int, anchor: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor hash of each window, which windows lie in one document, and the
    hashes of all anchor places."""
    span = window - anchor + 1
    ok = inside(first, window, len(h))
    if not ok.any():
        return np.zeros(0, U64), ok, np.zeros(0, U64)
    runs = run_hash(h, anchor)
    least = sliding(np.minimum, runs, span)
    # a run is an anchor if it is the least of one of the windows around it
    held = np.concatenate([np.zeros(span - 1, U64), np.where(ok, least, U64(0)), np.zeros(span - 1, U64)])
    return least, ok, runs[(sliding(np.maximum, held, span) == runs) & (runs > 0)]


def cell(anchors: np.ndarray, row: int) -> np.ndarray:
    return (mix(anchors + U64(row + 1)) & U64(WIDTH - 1)).astype(np.int64)


def _partial(found: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Sketch of the gathered anchors, as sorted cells with counts of 1 or 2."""
    values, counts = np.unique(np.concatenate(found), return_counts=True)
    for row in range(DEPTH):
        cells, where = np.unique(cell(values, row), return_inverse=True)
        many = np.bincount(where, weights=counts, minlength=len(cells)) > 1
        cut = np.searchsorted(cells, np.arange(0, WIDTH + 1, BLOCK))
        blocks = np.flatnonzero(np.diff(cut))
        yield pa.RecordBatch.from_pydict(
            {
                "block": pa.array(row * (WIDTH // BLOCK) + blocks, pa.int32()),
                "cells": pa.array([(cells[cut[b] : cut[b + 1]] % BLOCK).astype("<u4").tobytes() for b in blocks], pa.binary()),
                "many": pa.array([np.packbits(many[cut[b] : cut[b + 1]]).tobytes() for b in blocks], pa.binary()),
                "anchors": pa.array([int(counts.sum()) if row == 0 and b == blocks[0] else 0 for b in blocks], pa.int64()),
            }
        )


def _sketch(window: int, anchor: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, n = [], 0
        for batch in batches:
            for w in split_words(batch.column("text")):
                found.append(window_anchors(word_hash(w), w.first, window, anchor)[2])
                n += len(found[-1])
                if n > FLUSH:
                    yield from _partial(found)
                    found, n = [], 0
        if n:
            yield from _partial(found)

    return run


def _merge(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums one block of cells over all partial sketches; keeps which cells
    reach two."""
    counts, anchors = np.zeros(BLOCK, np.uint8), 0
    for batch in batches:
        anchors += sum(batch.column("anchors").to_pylist())
        for cells, many in zip(batch.column("cells").to_pylist(), batch.column("many").to_pylist(), strict=True):
            at = np.frombuffer(cells, "<u4")
            more = np.unpackbits(np.frombuffer(many, np.uint8), count=len(at))
            counts[at] = np.minimum(counts[at] + 1 + more, 2)
    yield pa.RecordBatch.from_pydict(
        {
            "block": pa.array([key[0].as_py()], pa.int32()),
            "bits": pa.array([np.packbits(counts > 1).tobytes()], pa.binary()),
            "anchors": pa.array([anchors], pa.int64()),
        }
    )


def merged_sketch(texts: DataFrame, window: int, anchor: int) -> tuple[np.ndarray, int]:
    """Cells of the merged sketch that reach two, one bit each, and the number
    of anchor places."""
    partial = texts.select("text").mapInArrow(_sketch(window, anchor), "block int, cells binary, many binary, anchors long")
    merged = partial.groupBy("block").applyInArrow(_merge, "block int, bits binary, anchors long")
    bits, anchors = np.zeros((DEPTH * (WIDTH // BLOCK), BLOCK // 8), np.uint8), 0
    for row in merged.toLocalIterator():
        bits[row["block"]] = np.frombuffer(row["bits"], np.uint8)
        anchors += row["anchors"]
    return bits.reshape(DEPTH, WIDTH // 8), anchors


def estimated_repeated(bits: np.ndarray, anchors: np.ndarray) -> np.ndarray:
    """Whether the sketch's estimate for each window's anchor is two or more."""
    new = np.ones(len(anchors), bool)
    new[1:] = anchors[1:] != anchors[:-1]
    distinct = anchors[new]
    hot = np.ones(len(distinct), bool)
    for row in range(DEPTH):
        c = cell(distinct, row)
        hot &= (bits[row][c >> 3] >> (7 - (c & 7)).astype(np.uint8)) & 1 == 1
    return hot[np.cumsum(new) - 1]


def repeats(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which pairs (a, b) occur more than once, and which are the first of
    their kind."""
    many, lead = np.zeros(len(a), bool), np.zeros(len(a), bool)
    order = np.lexsort((a, b))
    same = (a[order][1:] == a[order][:-1]) & (b[order][1:] == b[order][:-1])
    many[order[1:][same]] = True
    many[order[:-1][same]] = True
    lead[order] = np.concatenate([np.ones(min(1, len(a)), bool), ~same])
    return many, lead


def binary_rows(values: np.ndarray, row_first: np.ndarray) -> pa.BinaryArray:
    """Binary column whose row i holds ``values[row_first[i]:row_first[i + 1]]``."""
    off = (row_first * values.dtype.itemsize).astype(np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), len(off) - 1, [None, pa.py_buffer(off), pa.py_buffer(np.ascontiguousarray(values))])


def binary_values(column: pa.Array | pa.ChunkedArray, dtype: str) -> tuple[np.ndarray, np.ndarray]:
    """Values of a binary column, and how many each row holds."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    _, off, data = column.buffers()
    o = np.frombuffer(off, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8)[o[0] : o[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw.view(dtype), np.diff(o) // np.dtype(dtype).itemsize


ENTRIES = "bucket int, key binary, anchor long, start int, places binary, windows binary, asks binary, known binary"
_EMPTY = {"anchor": pa.int64(), "start": pa.int32(), "places": pa.binary(), "windows": pa.binary(), "asks": pa.binary()}


def ranges(row: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of neighbouring places: row, first place, number of places."""
    if not len(row):
        return row, place, place
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (place[1:] != place[:-1] + 1)
    at = np.flatnonzero(new)
    return row[at], place[at], np.diff(np.append(at, len(row)))


def _range_rows(row: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, pa.BinaryArray]:
    """Rows that hold places, and their ranges as pairs of 32-bit numbers."""
    r, start, n = ranges(row, place)
    rows, first = np.unique(r, return_index=True)
    pairs = np.stack([start, n], axis=1).astype("<i4").ravel()
    return rows, binary_rows(pairs, 2 * np.append(first, len(r)).astype(np.int64))


def _entries(window: int, anchor: int, buckets: int, sketch):
    """Windows estimated repeated, grouped within the batch: known repeats as
    ranges, and one entry for each distinct window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = sketch.value
        for batch in batches:
            rows, places, anchors, wins = [], [], [], []
            for w in split_words(batch.column("text")):
                h = word_hash(w)
                least, ok, _ = window_anchors(h, w.first, window, anchor)
                at = np.flatnonzero(ok)
                at = at[estimated_repeated(bits, least[at])] if len(at) else at
                if len(at):
                    doc = w.doc[at]
                    rows.append(w.row + doc)
                    places.append(at - w.first[doc])
                    anchors.append(least[at])
                    wins.append(run_hash(h, window, salt=1)[at])
            if not rows:
                continue
            row, place, anc, win = (np.concatenate(x) for x in (rows, places, anchors, wins))
            many, lead = repeats(anc, win)
            keys = batch.column("key")
            # equal rows have one key and the same repeats: one of them tells
            key_of = batch.column("key").dictionary_encode().indices.to_numpy().astype(np.int64)
            told = np.unique(key_of, return_index=True)[1][key_of] == np.arange(len(key_of))
            hit, known = _range_rows(row[many & told[row]], place[many & told[row]])
            yield pa.RecordBatch.from_pydict(
                {
                    "bucket": pa.array(hit % buckets, pa.int32()), "key": keys.take(pa.array(hit)),
                    **{c: pa.nulls(len(hit), t) for c, t in _EMPTY.items()}, "known": known,
                }
            )
            row, place, anc, win, ask = row[lead], place[lead], anc[lead], win[lead], ~many[lead]
            new = np.ones(len(row), bool)
            new[1:] = (row[1:] != row[:-1]) | (anc[1:] != anc[:-1]) | (place[1:] // 256 != place[:-1] // 256)
            at = np.flatnonzero(new)
            off = np.append(at, len(row))
            start = place[at] // 256 * 256
            for a in range(0, len(at), 50_000):  # bounded Arrow batches
                b = min(a + 50_000, len(at))
                span, o = slice(off[a], off[b]), off[a : b + 1] - off[a]
                yield pa.RecordBatch.from_pydict(
                    {
                        "bucket": pa.array((anc[at[a:b]] % U64(buckets)).astype(np.int32)), "key": keys.take(pa.array(row[at[a:b]])),
                        "anchor": pa.array(anc[at[a:b]].view(np.int64)), "start": pa.array(start[a:b].astype(np.int32)),
                        "places": binary_rows((place[span] % 256).astype(np.uint8), o), "windows": binary_rows(win[span], o),
                        "asks": binary_rows(ask[span].astype(np.uint8), o), "known": pa.nulls(b - a, pa.binary()),
                    }
                )

    return run


def _resolve(table: pa.Table) -> pa.Table:
    """Exact groups of one bucket's entries: ranges of repeated windows."""
    import pyarrow.compute as pc

    known = table.filter(pc.is_valid(table["known"]))
    asked = table.filter(pc.is_valid(table["windows"]))
    out = [pa.table({"key": known["key"], "ranges": known["known"]})]
    if len(asked):
        win, n = binary_values(asked["windows"], "<u8")
        place = binary_values(asked["places"], "u1")[0].astype(np.int64) + np.repeat(asked["start"].to_numpy(), n)
        anc = np.repeat(asked["anchor"].to_numpy().view(U64), n)
        many = repeats(anc, win)[0] & (binary_values(asked["asks"], "u1")[0] == 1)
        hit, found = _range_rows(np.repeat(np.arange(len(n)), n)[many], place[many])
        out.append(pa.table({"key": asked["key"].combine_chunks().take(pa.array(hit)), "ranges": found}))
    schema = pa.schema([("key", pa.binary()), ("ranges", pa.binary())])
    return pa.concat_tables([t.cast(schema) for t in out])


def removed_words(w: Words, column: pa.Array, window: int) -> np.ndarray:
    """Which words of a slice are covered by the windows of ``column``, lists
    of binary ranges for each document of the batch."""
    cover = np.zeros(len(w.start) + 1, np.int64)
    lists = column.slice(w.row, w.n_docs)
    pairs, n = binary_values(lists.flatten(), "<i4")
    per = np.diff(lists.offsets.to_numpy()) if len(lists) else np.zeros(0, int)
    doc = np.repeat(np.repeat(np.arange(w.n_docs), per), n // 2)
    start = w.first[doc] + pairs[0::2]
    np.add.at(cover, start, 1)
    np.add.at(cover, start + pairs[1::2] + window - 1, -1)
    return np.cumsum(cover[:-1]) > 0


def joined(w: Words, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 of the kept words of each document, joined by one space, and the
    byte offsets of the documents."""
    data, mask = w.data.copy(), np.zeros(len(w.data) + 1, np.int8)
    at = np.flatnonzero(keep)
    mask[w.start[at]] += 1
    np.add.at(mask, w.end[at], -1)
    mask = np.cumsum(mask[:-1], dtype=np.int8).astype(bool)
    doc = w.doc[at]
    later = at[1:][doc[1:] == doc[:-1]]  # all but the first kept word of a document
    data[w.start[later] - 1] = 0x20
    mask[w.start[later] - 1] = True
    return data[mask], np.concatenate([[0], np.cumsum(mask)])[w.offsets]


def _cut(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for w in split_words(batch.column("text")):
                gone = removed_words(w, batch.column("ranges"), window)
                data, off = joined(w, ~gone)
                total = np.concatenate([[0], np.cumsum(gone)])
                kept = pa.LargeStringArray.from_buffers(w.n_docs, pa.py_buffer(off.astype(np.int64)), pa.py_buffer(data))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").slice(w.row, w.n_docs), pa.array(np.diff(w.first), pa.int64()),
                        pa.array(np.diff(total[w.first]), pa.int64()), kept.cast(pa.string()),
                    ],
                    names=["id", "n_words", "n_removed", "kept"],
                )

    return run


def remove_repeats(
    docs: DataFrame, window: int = 35, anchor: int = 20, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """For each document: ``id_col``, ``n_words``, ``n_removed`` and ``kept``,
    the words that are left, joined by one space."""
    if not 0 < anchor <= window <= 256:
        raise ValueError("0 < anchor <= window <= 256 is needed")
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    keyed = texts.withColumn(
        "key", F.unhex(F.md5(F.concat_ws(":", F.coalesce(F.col("id").cast("string"), F.lit("null")), F.coalesce("text", F.lit("")))))
    )
    bits, anchors = merged_sketch(texts, window, anchor)
    buckets = max(LEAST_BUCKETS, anchors // ANCHORS_A_BUCKET)
    sketch = spark.sparkContext.broadcast(bits)
    entries = keyed.select("key", "text").mapInArrow(_entries(window, anchor, buckets, sketch), ENTRIES)
    found = entries.groupBy("bucket").applyInArrow(_resolve, "key binary, ranges binary")
    # batches that hold several copies of a row tell the same ranges of it: a set keeps them once
    per_key = found.groupBy(F.col("key").alias("found_key")).agg(F.collect_set("ranges").alias("found"))
    joined_docs = keyed.join(per_key.hint("shuffle_hash"), F.col("key") == F.col("found_key"), "left")
    ready = joined_docs.select("id", "text", F.coalesce("found", F.array().cast("array<binary>")).alias("ranges"))
    kind = docs.schema[id_col].dataType.simpleString()
    out = ready.mapInArrow(_cut(window), f"id {kind}, n_words long, n_removed long, kept string")
    return out.withColumnRenamed("id", id_col)
