"""Phrase collocations from sorted count streams (operator 13).

Counting goes by length.  Words are numbered within *units* (texts of one
task, about ``UNIT_BYTES``); a unit's distinct words of each language go
to buckets, which sum them over all units, give the frequent ones ids and
answer the units.  A phrase of k + 1 words can only be frequent if both its parts
of k words are, so the units count pairs of neighbouring frequent parts and
send them, sorted and compressed, to buckets, which sum them, name the
frequent ones and answer; and so on.  No place is counted that cannot matter,
and none is left out.  Phrases are told apart by their words and by pairs of
ids, never by hashes of texts.

The counts of all lengths then form one stream, laid out twice:

* in *prefix order* (by first word, then second, ...) every phrase stands
  behind its first parts and before its longer continuations.  One pass with a
  stack of at most ``longest`` phrases merges the lengths in lockstep and reads
  off every phrase's left counts and its most frequent continuation;
* in *suffix order* (by last word, then the one before, ...) a second such
  pass reads off the right counts and the most frequent extension to the left,
  and scores what is left.

The streams are range-partitioned and sorted, so a partition may begin inside
the phrases of one word, however many these are; the few phrases that its
first row continues (at most ``longest`` for each partition) are handed to it.

Defined cases: null and empty texts have no words; a null language counts as
``und``, together with a language of that name; equal rows count as several;
ties are ranked by count and then by phrase in UTF-8 order; an empty table
gives an empty result.  Only text and language are read.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from quantis.llm.vocabulary import packed, runs, take_spans, unpacked
from quantis.llm.wordbatch import LOWER_AZ, PLACE, U64, bytes_hash, mix, slices, texts, utf8
from quantis.llm.work import bounded_batches, cut, release, stored

UNIT_BYTES = 8 << 20
#: Parts of a language that are ranked apart first.
SALTS = 32

# What ends a piece, and what ends a word.
BREAKS = np.zeros(256, bool)
BREAKS[list(b".,;:!?\x0a\x0b\x0c\x0d")] = True
GAPS = BREAKS.copy()
GAPS[[0x20, 0x09]] = True

#: A unit's places (lang null), and its words of each language and bucket.
LEVEL = "unit string, bucket int, lang string, first int, words binary, held binary, total long, at binary, numbers binary"
#: Frequent words of a bucket (unit null), and its answer to each unit.
WORD_SUMS = "lang string, word string, n long, id long, unit string, places binary, ids binary"
#: A unit's places (bucket null), and its pairs for each bucket.
STEP = "unit string, bucket int, first int, lefts binary, rights binary, held binary, at binary, numbers binary"
#: Frequent pairs of a bucket (unit null), and its answer to each unit.
SUMS = "left long, right long, n long, id long, unit string, places binary, ids binary"
#: Bytes of the corpus for each bucket, and fewest buckets: a bucket sums at most the words of as many bytes.
BYTES_A_BUCKET, LEAST_BUCKETS = 10_000_000, 64


def piece_words(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Byte ranges of the words of a run of documents, their documents, and
    whether each begins a piece."""
    gap = GAPS[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[off] = True
    open_ = np.ones(len(data) + 2, bool)
    open_[1:-1] = gap
    start = np.flatnonzero(~gap & (open_[:-2] | edge[:-1]))
    end = np.flatnonzero(~gap & (open_[2:] | edge[1:])) + 1
    doc = np.searchsorted(off, start, side="right") - 1
    broken = np.concatenate([[0], np.cumsum(BREAKS[data])])[start]
    first = np.ones(len(start), bool)
    first[1:] = (broken[1:] != broken[:-1]) | (doc[1:] != doc[:-1])
    return start, end, doc, first


LEVEL_KINDS = (pa.string(), pa.int32(), pa.string(), pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.binary(), pa.binary())


def _unit_rows(parts: list, buckets: int) -> Iterator[tuple]:
    """A row for each bucket and language of a unit, with its distinct words
    and their counts, and one with the unit's words by place.  Places of
    neighbours in a piece are one apart, others at least two."""
    name, none = uuid.uuid4().hex, None
    words = pa.chunked_array([p[0] for p in parts]).dictionary_encode().combine_chunks()
    number = words.indices.to_numpy().astype(np.int64)
    data, off = utf8(words.dictionary)
    langs: dict[str, int] = {}
    lang = np.concatenate([np.array([langs.setdefault(x, len(langs)) for x in p[1]], np.int64)[p[2]] for p in parts])
    first = np.concatenate([p[3] for p in parts])
    n = len(off) - 1
    key, where, held = np.unique(lang * n + number, return_inverse=True, return_counts=True)
    salt = np.array([zlib.crc32(x.encode()) for x in langs], U64)
    bucket = (mix(bytes_hash(data, off[:-1], off[1:])[key % n] + salt[key // n]) % U64(buckets)).astype(np.int64)
    order = np.lexsort((key, bucket))
    key, held, bucket = key[order], held[order], bucket[order]
    moved = np.empty(len(order), np.int64)
    moved[order] = np.arange(len(order))
    at = np.arange(len(first)) + np.cumsum(first)
    yield name, none, none, none, none, none, none, packed(np.diff(at, prepend=0)), packed(moved[where])
    # every word with a space after it
    body, begin = take_spans(np.append(data, np.uint8(0x20)), off[key % n], off[key % n + 1] + 1)
    body[begin[1:] - 1] = 0x20
    names = list(langs)
    for a, b in runs(bucket * len(names) + key // n):
        spelled = zlib.compress(body[begin[a] : begin[b] - 1].tobytes(), 1)
        yield name, int(bucket[a]), names[key[a] // n], a, spelled, packed(held[a:b]), int(held[a:b].sum()), none, none


def _units(buckets: int):
    def batch(parts: list) -> pa.RecordBatch:
        columns = zip(*_unit_rows(parts, buckets), strict=True)
        names = [x.split(" ")[0] for x in LEVEL.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, LEVEL_KINDS, strict=True)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [], 0
        for batch_ in batches:
            data, off = utf8(texts(batch_.column("text")))
            langs = batch_.column("lang").to_pylist()
            for a, b in slices(off):
                d, o = LOWER_AZ[data[off[a] : off[b]]], off[a : b + 1] - off[a]
                start, end, doc, first = piece_words(d, o)
                if not len(start):
                    continue
                body, at = take_spans(d, start, end)
                words = pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(at.astype(np.int64)), pa.py_buffer(body))
                parts.append((words, langs[a:b], doc, first))
                size += len(d)
                if size >= UNIT_BYTES:
                    yield batch(parts)
                    parts, size = [], 0
        if parts:
            yield batch(parts)
        release()

    return run


def answers_to(units: list[str], first: list[int], ends: np.ndarray, found: np.ndarray) -> list[tuple[str, bytes, bytes]]:
    """For each unit's list (by its first place in the unit, and its end in
    ``found``): the places that got an id, and these ids."""
    out = []
    for name, begin, a, b in zip(units, first, [0, *ends[:-1].tolist()], ends.tolist(), strict=True):
        hit = np.flatnonzero(found[a:b] >= 0)
        if len(hit):
            out.append((name, packed(begin + hit), packed(found[a:b][hit])))
    return out


def summed_table(columns: list[np.ndarray | pa.Array], answers: list[tuple], names: list[str]) -> pa.Table:
    """Rows of frequent phrases, then rows of answers."""
    n, m = len(columns[0]), len(answers)
    whole = [pa.concat_arrays([c if isinstance(c, pa.Array) else pa.array(c, pa.int64()), pa.nulls(m, c.type if isinstance(c, pa.Array) else pa.int64())]) for c in columns]
    kinds = (pa.string(), pa.binary(), pa.binary())
    whole += [pa.array([None] * n + [a[k] for a in answers], t) for k, t in enumerate(kinds)]
    return pa.table(whole, names=[*names, "unit", "places", "ids"])


def _word_sums(least: int):
    """Frequent words of a bucket by language, with counts and ids, and for
    each unit the places of its frequent words with their ids."""

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        lists, langs = [], table["lang"].to_pylist()
        for lang, raw in zip(langs, table["words"].to_pylist(), strict=True):
            words = pa.array(zlib.decompress(raw).decode().split(" "), pa.large_string())
            # a word holds no space, so the first one ends it
            lists.append(pc.binary_join_element_wise(words, pa.scalar(lang, pa.large_string()), pa.scalar(" ", pa.large_string())))
        ends = np.cumsum([len(x) for x in lists])
        held = np.concatenate([unpacked(x) for x in table["held"].to_pylist()])
        coded = pa.chunked_array(lists).dictionary_encode().combine_chunks()
        number = coded.indices.to_numpy().astype(np.int64)
        total = np.bincount(number, weights=held).astype(np.int64)
        many = np.flatnonzero(total >= least)
        id_of = np.full(len(total), -1, np.int64)
        id_of[many] = (np.int64(key[0].as_py()) << 32) + np.arange(len(many))
        named = [x.split(" ", 1) for x in coded.dictionary.take(pa.array(many)).to_pylist()]
        columns = [pa.array([x[1] for x in named], pa.string()), pa.array([x[0] for x in named], pa.string()), total[many], id_of[many]]
        return summed_table(columns, answers_to(table["unit"].to_pylist(), table["first"].to_pylist(), ends, id_of[number]), ["lang", "word", "n", "id"])

    return run


def answered_rows(answers: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Places in a unit's list, ascending, and the ids that they got."""
    place, ids = (np.concatenate([unpacked(x) for x in answers[c].to_pylist()]) for c in ("places", "ids"))
    order = np.argsort(place)
    return place[order], ids[order]


def _longer(buckets: int):
    """Pairs of neighbouring frequent phrases of a unit: phrases one word
    longer, with their places."""
    schema = pa.schema(
        [("unit", pa.string()), ("bucket", pa.int32()), ("first", pa.int32()), ("lefts", pa.binary()), ("rights", pa.binary()),
         ("held", pa.binary()), ("at", pa.binary()), ("numbers", pa.binary())]
    )

    def run(unit: pa.Table, answers: pa.Table) -> pa.Table:
        if not len(unit) or not len(answers):
            return schema.empty_table()
        at, number = np.cumsum(unpacked(unit["at"][0].as_py())), unpacked(unit["numbers"][0].as_py())
        place, ids = answered_rows(answers)
        known = np.full(int(max(number.max(initial=0), place.max(initial=0))) + 1, -1, np.int64)
        known[place] = np.arange(len(place))
        rank = known[number]
        alive = rank >= 0
        at, rank = at[alive], rank[alive]
        beside = np.flatnonzero(np.diff(at) == 1)
        key, where, held = np.unique(rank[beside] * len(ids) + rank[beside + 1], return_inverse=True, return_counts=True)
        if not len(key):
            return schema.empty_table()
        left, right = ids[key // len(ids)], ids[key % len(ids)]
        bucket = (mix(left.astype(U64) * U64(PLACE) + right.astype(U64)) % U64(buckets)).astype(np.int64)
        order = np.lexsort((right, left, bucket))
        left, right, held, bucket = left[order], right[order], held[order], bucket[order]
        moved = np.empty(len(order), np.int64)
        moved[order] = np.arange(len(order))
        name, none = unit["unit"][0].as_py(), None
        rows = [(name, none, none, none, none, none, packed(np.diff(at[beside], prepend=0)), packed(moved[where]))]
        for a, b in runs(bucket):
            rows.append(
                (name, int(bucket[a]), a, packed(np.diff(left[a:b], prepend=0)), packed(right[a:b]), packed(held[a:b]), none, none)
            )
        return pa.table([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    return run


def _bucket_sums(least: int):
    """Frequent pairs of a bucket with their counts and ids, and for each unit
    the places of its frequent pairs with their ids."""

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        left = [np.cumsum(unpacked(x)) for x in table["lefts"].to_pylist()]
        size = np.array([len(x) for x in left])
        left = np.concatenate(left)
        right, held = (np.concatenate([unpacked(x) for x in table[c].to_pylist()]) for c in ("rights", "held"))
        order = np.lexsort((right, left))
        new = np.flatnonzero(np.concatenate([[True], (np.diff(left[order]) != 0) | (np.diff(right[order]) != 0)]))
        total = np.add.reduceat(held[order], new)
        many = np.flatnonzero(total >= least)
        ids = (np.int64(key[0].as_py()) << 32) + np.arange(len(many))
        id_of = np.full(len(new), -1, np.int64)
        id_of[many] = ids
        found = np.empty(len(order), np.int64)
        found[order] = np.repeat(id_of, np.diff(np.append(new, len(order))))
        at = order[new[many]]
        answers = answers_to(table["unit"].to_pylist(), table["first"].to_pylist(), np.cumsum(size), found)
        return summed_table([left[at], right[at], total[many], ids], answers, ["left", "right", "n", "id"])

    return run


def frequent_phrases(docs: DataFrame, longest: int, least: int, text_col: str, lang_col: str) -> DataFrame:
    """lang, words (an array) and n of every phrase of up to ``longest`` words
    that occurs at least ``least`` times; the phrase without words holds its
    language's number of words."""
    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit("und"))
    rows = docs.select(F.col(text_col).alias("text"), lang.alias("lang"))
    # a word and the gap after it take two bytes at least; what they usually take is enough to size the buckets
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    buckets = max(LEAST_BUCKETS, size // BYTES_A_BUCKET)
    units = stored(rows.mapInArrow(_units(buckets), LEVEL))
    asked = units.filter("lang is not null")
    everything = asked.groupBy("lang").agg(F.sum("total").alias("n"))
    sums = stored(asked.select("bucket", "unit", "lang", "first", "words", "held").groupBy("bucket").applyInArrow(_word_sums(least), WORD_SUMS))
    known = sums.filter("unit is null").select("lang", F.array("word").alias("words"), "n", "id")
    found = [everything.select("lang", F.array().cast("array<string>").alias("words"), "n"), known.select("lang", "words", "n")]
    answers = sums.filter("unit is not null").select(F.col("unit").alias("of"), "places", "ids")
    at = units.filter("lang is null").select("unit", "at", "numbers")
    for _ in range(2, longest + 1):
        step = stored(at.groupBy("unit").cogroup(answers.groupBy("of")).applyInArrow(_longer(buckets), STEP))
        asked = step.filter("bucket is not null").select("bucket", "unit", "first", "lefts", "rights", "held")
        sums = stored(asked.groupBy("bucket").applyInArrow(_bucket_sums(least), SUMS))
        counted = sums.filter("unit is null").select("left", "right", "n", "id")
        begin = known.select(F.col("id").alias("left"), "lang", F.col("words").alias("begin"))
        last = known.select(F.col("id").alias("right"), F.element_at("words", -1).alias("last"))
        known = stored(
            counted.join(begin, "left").join(last, "right")
            .select("lang", F.concat("begin", F.array("last")).alias("words"), "n", "id")
        )
        found.append(known.select("lang", "words", "n"))
        answers = sums.filter("unit is not null").select(F.col("unit").alias("of"), "places", "ids")
        at = step.filter("bucket is null").select("unit", "at", "numbers")
    return reduce(DataFrame.union, found)


class Merge:
    """Lockstep pass over a sorted stream of phrases of all lengths: every
    phrase follows its shorter ones, which stand on a stack."""

    def __init__(self, above: dict, percent: int):
        self.above, self.percent = above, percent
        self.stack: list[list] = []  # words, n, most frequent extension, row (None: another partition's phrase)
        self.lang: str | None = None
        self.begun = False

    def push(self, lang: str, words: list[str], n: int, row) -> Iterator[tuple]:
        """Takes the next phrase; gives those that are finished by it."""
        if lang != self.lang or not self.begun:
            yield from self.flush()
            self.lang = lang
        if not self.begun:  # what the first row of a partition continues
            self.begun = True
            for k in range(len(words)):
                self.stack.append([words[:k], self.above[(lang, tuple(words[:k]))], 0, None])
        while self.stack and self.stack[-1][0] != words[: len(self.stack[-1][0])]:
            yield self.pop()
        if self.stack:
            self.stack[-1][2] = max(self.stack[-1][2], n)
        self.stack.append([words, n, 0, row])

    def pop(self) -> tuple:
        words, n, most, row = self.stack.pop()
        # the counts of its shorter phrases, shortest first; the first is the language's number of words
        return self.lang, words, n, [x[1] for x in self.stack], row, len(words) > 1 and 100 * most >= self.percent * n

    def flush(self) -> Iterator[tuple]:
        while self.stack:
            yield self.pop()


FORWARD = "lang string, words array<string>, n long, shorter array<long>, covered boolean, mark boolean"
SCORED = "lang string, words array<string>, a long, l long, r long, n long, score long, mark boolean"


def _rows(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch.column(c).to_pylist() for c in columns), strict=True)


def _batched(rows: Iterator[tuple], schema: pa.Schema, size: int = 20_000) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)

    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield batch()
            held = []
    if held:
        yield batch()


def _forward(above, percent: int):
    """Prefix order: each phrase with the counts of its first parts."""
    schema = pa.schema(
        [("lang", pa.string()), ("words", pa.list_(pa.string())), ("n", pa.int64()), ("shorter", pa.list_(pa.int64())),
         ("covered", pa.bool_()), ("mark", pa.bool_())]
    )

    def finished(found: Iterator[tuple]) -> Iterator[tuple]:
        for lang, words, n, shorter, row, covered in found:
            if row is not None:
                yield lang, words, n, shorter, covered, False
            elif covered:
                yield lang, words, n, [], True, True

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merge = Merge(above.value, percent)

        def everything() -> Iterator[tuple]:
            for lang, words, n in _rows(batches, ["lang", "words", "n"]):
                yield from finished(merge.push(lang, words, n, True))
            yield from finished(merge.flush())

        yield from _batched(everything(), schema)

    return run


def best_cut(a: int, n: int, left: list[int], right: list[int]) -> tuple[int, int, int]:
    """Least score over the cuts of a phrase, the first of equal ones, with
    the counts of both parts; exact integers."""
    return min(((1000 * a * n // (l * r), l, r) for l, r in zip(left, right, strict=True)), key=lambda x: x[0])  # noqa: E741


def _backward(above, percent: int):
    """Suffix order: scores of the phrases that no longer one covers."""
    schema = pa.schema(
        [("lang", pa.string()), ("words", pa.list_(pa.string())), ("a", pa.int64()), ("l", pa.int64()), ("r", pa.int64()),
         ("n", pa.int64()), ("score", pa.int64()), ("mark", pa.bool_())]
    )

    def finished(found: Iterator[tuple]) -> Iterator[tuple]:
        for lang, words, n, shorter, row, covered in found:
            if row is None:
                if covered:
                    yield lang, words[::-1], n, None, None, None, None, True
            elif len(words) > 1 and not covered and not row[1]:
                # the cut after k words leaves a right part of len(words) - k
                score, left, right = best_cut(n, shorter[0], row[0][1:], shorter[:0:-1])
                yield lang, words[::-1], n, left, right, shorter[0], score, False

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merge = Merge(above.value, percent)

        def everything() -> Iterator[tuple]:
            for lang, words, n, shorter, covered in _rows(batches, ["lang", "words", "n", "shorter", "covered"]):
                yield from finished(merge.push(lang, words, n, (shorter, covered)))
            yield from finished(merge.flush())

        yield from _batched(everything(), schema)

    return run


def laid_out(rows: DataFrame) -> tuple[DataFrame, dict]:
    """The rows (lang, words, ...) as a sorted stream in range partitions, and
    the counts of the phrases that the first rows of partitions continue: at
    most one fewer than the longest phrase's words for each partition."""
    stream = cut(rows.repartitionByRange("lang", "words").sortWithinPartitions("lang", "words"))
    heads = stream.groupBy(F.spark_partition_id()).agg(F.min(F.struct("lang", "words")).alias("head")).select("head.*").collect()
    above = {(h["lang"], tuple(h["words"][:k])) for h in heads for k in range(len(h["words"]))}
    if not above:
        return stream, {}
    wanted = stream.sparkSession.createDataFrame([(lang, list(w)) for lang, w in sorted(above)], "lang string, words array<string>")
    found = stream.join(F.broadcast(wanted), ["lang", "words"]).select("lang", "words", "n").collect()
    return stream, {(r["lang"], tuple(r["words"])): r["n"] for r in found}


def phrases(
    docs: DataFrame, longest: int = 5, least: int = 100, percent: int = 100, top: int = 2000, text_col: str = "text", lang_col: str = "lang"
) -> DataFrame:
    """``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n`` and ``score``
    of the ``top`` best phrases of each language."""
    with bounded_batches(docs.sparkSession):
        return _phrases(docs, longest, least, percent, top, text_col, lang_col)


def _phrases(docs: DataFrame, longest: int, least: int, percent: int, top: int, text_col: str, lang_col: str) -> DataFrame:
    spark = docs.sparkSession
    stream, above = laid_out(frequent_phrases(docs, longest, least, text_col, lang_col))
    forward = cut(stream.mapInArrow(_forward(spark.sparkContext.broadcast(above), percent), FORWARD))
    turned = forward.filter("not mark").withColumn("words", F.reverse("words"))
    stream, above = laid_out(turned)
    scored = stored(stream.mapInArrow(_backward(spark.sparkContext.broadcast(above), percent), SCORED))
    # marks: phrases covered by one in another partition, fewer than ``longest`` for each partition
    marks = forward.filter("mark").select("lang", "words").union(scored.filter("mark").select("lang", "words"))
    left = scored.filter("not mark").join(F.broadcast(marks), ["lang", "words"], "left_anti")
    named = left.select("lang", F.array_join("words", " ").alias("phrase"), "a", "l", "r", "n", "score")
    # the best of each of some parts of a language, so that its last task ranks SALTS * top rows at most
    best = [F.desc("score"), F.desc("a"), F.col("phrase")]
    dealt = named.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    place = F.row_number().over(W.partitionBy("lang", "salt").orderBy(*best))
    named = dealt.withColumn("place", place).filter(F.col("place") <= top)
    order = W.partitionBy("lang").orderBy(*best)
    ranked = named.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
