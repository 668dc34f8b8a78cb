"""Language-model scoring by a probabilistic suffix tree (operator 3).

The model writes a text symbol by symbol: the bytes of its words (A-Z in
lower case), one space between words, and an end.  Every byte is a symbol.

* Counting: a *unit* (texts of one task, about 8 MB) sorts its runs of ``depth``
  context symbols and the next one.  The symbol is written first and its
  context newest first, so one sort orders the runs of every depth.  Distinct
  runs, with their counts in training texts, go to buckets as sorted and
  compressed lists, and the buckets add them up.  The depths travel in pairs, six
  with five and four with three: the bucket is a hash of the shorter context, so the
  longer runs of a bucket hold all of its shorter ones, which no list repeats.  A
  shorter context's load is one entry for each of its next symbols and older ones
  from each unit, and contexts are spread evenly however frequent their newest
  symbols are.
* Retention: a context stays a candidate if it occurs at least ``least``
  times, whatever the size of the corpus, so the tree grows with the input.
  It becomes a state if its next-symbol distribution diverges from that of
  the context without the oldest symbol by more code length, summed over its
  occurrences, than describing it takes: n * KL > (m - 1) / 2 * log2(n) + 1 for
  m next symbols.  States bring their shorter contexts along.
* Smoothing: a state's distribution is mixed with its shorter context's by
  Witten-Bell weights, down to the root, which is mixed with equal chances.
  Only symbols that were seen after a state have rows; others fall back to the
  shorter context by its weight.
* Scoring: the longest state that is a suffix of what was written gives the
  next symbol's chance.  The states meet the units' lists in the same buckets,
  which answer each unit with a chance or a weight for its runs; states of up
  to ``NEAR`` symbols (at most 257) are broadcast.  The unit's texts are added up
  from these answers.

The unigram base needs every word's count, which no task could hold.  A unit
sends each distinct word, with its training count, to the word's bucket; the
buckets answer with the counts of the whole corpus, and the unit adds them up for
its texts together with the chances.

Defined cases: null and empty texts are scored as an end alone; a null id is
taken as the empty text when rows are held out (it is held out); with no
training rows the counts are 0 and the tree is its root; equal rows get equal
scores; an empty table gives an empty result.  Only id and text are read.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quantis.llm.units import digest, named
from quantis.llm.vocabulary import packed, runs, unpacked
from quantis.llm.wordbatch import IS_SPACE, PLACE, U64, Words, mix, split_words, word_hash
from quantis.llm.work import bounded_batches, passing_folder, release
from quantis.llm.work import stored_alone as stored

DEPTH, LEAST = 6, 10
#: Longest contexts whose states every worker holds: at most 257 of them, with 256 next symbols each.
NEAR = 1
SYMBOLS = 256
#: Ends a text, and stands before it: a line feed is no part of any word.
END = 0x0A
LEAST_BUCKETS, TEXTS_A_BUCKET = 64, 4_000
#: Texts whose runs are sorted together: a run of seven bytes leaves one for the text.
TEXTS = 256


def held_out(id_: Column, folds: int = 10) -> Column:
    """Whether a row is kept from training: crc32 of its id as text."""
    return F.crc32(F.coalesce(id_.cast("string"), F.lit("")).cast("binary")) % folds == 0


def text_runs(data: np.ndarray, off: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The run of each place of texts given as bytes and offsets, and the range
    of places of each text (its symbols and its end).

    A run is a number of ``depth + 1`` bytes: the symbol at the place in the
    highest one, then its context, newest first.  So sorted runs are sorted
    at every depth, and shifting bytes out shortens the context."""
    n = np.diff(off)
    first = np.concatenate([[0], np.cumsum(n + depth + 1)])
    place = np.ones(first[-1], bool)
    place[(first[:-1, None] + np.arange(depth)).ravel()] = False
    written = place.copy()
    written[first[1:] - 1] = False
    s = np.full(first[-1] + 7, END, np.uint8)
    s[7:][written] = data
    # eight bytes up to a place, read as one number, have the last byte highest
    back = np.ndarray(first[-1], "<u8", s, strides=(1,))
    return (back >> np.uint64(8 * (7 - depth))).view(np.int64)[place], np.concatenate([[0], np.cumsum(n + 1)])


def body(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """Words of each text, joined by one space, and the texts' offsets."""
    n = np.diff(w.first)
    later = np.ones(len(w.start), bool)  # all but the first word of a text
    later[w.first[:-1][n > 0]] = False
    between = w.start[later] - 1
    data, mask = w.data.copy(), ~IS_SPACE[w.data]
    data[between] = 0x20
    mask[between] = True
    upto = np.concatenate([[0], np.cumsum(w.end - w.start)])[w.first]
    return data[mask], np.concatenate([[0], np.cumsum(np.diff(upto) + np.maximum(n - 1, 0))])


def context_of(run: np.ndarray, k: int) -> np.ndarray:
    return run & ((1 << (8 * k)) - 1)


def listed_with(k: int, depth: int) -> int:
    """Depth whose lists hold the runs of depth ``k``."""
    return k + 1 if NEAR < k < depth and (depth - k) % 2 else k


def served(head: int, depth: int) -> list[int]:
    """Depths whose runs the lists of a depth hold."""
    return [k for k in range(head, max(head - 2, -1), -1) if listed_with(k, depth) == head]


def bucket_of(run: np.ndarray, k: int, depth: int, buckets: int) -> np.ndarray:
    """Bucket of runs of depth ``k``: by the shortest whole context that their
    lists serve, or by the run where every worker holds the states."""
    least = served(listed_with(k, depth), depth)[-1]
    key = run if k <= NEAR else context_of(run >> (8 * (k - least)), least)
    return (mix(key.astype(U64) * U64(PLACE) + U64(least + 1)) % U64(buckets)).astype(np.int64)


@dataclass
class Level:
    """Distinct runs of one depth, and how messages list them: by bucket, then
    by run."""

    run: np.ndarray
    new: np.ndarray  # first of the whole runs that each stands for
    order: np.ndarray
    bucket: np.ndarray


class Levels:
    """Distinct runs of a unit at every depth.  A depth is made when it is asked
    for: all of them would take many times the memory of the unit's texts."""

    def __init__(self, whole: np.ndarray, depth: int, buckets: int):
        self.whole, self.depth, self.buckets = whole, depth, buckets

    def at(self, k: int) -> Level:
        short = self.whole >> (8 * (self.depth - k))
        new = firsts(short)
        short = short[new]
        bucket = bucket_of(short, k, self.depth, self.buckets).astype("<u2" if self.buckets < 1 << 16 else "<i4")
        order = np.argsort(bucket, kind="stable")
        return Level(short, new, order, bucket[order])

    @property
    def run(self) -> list[np.ndarray]:
        return [self.at(k).run for k in range(self.depth + 1)]

    @property
    def bucket(self) -> list[np.ndarray]:
        return [self.at(k).bucket for k in range(self.depth + 1)]


def firsts(code: np.ndarray) -> np.ndarray:
    """Places of the first of equal neighbours."""
    return np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]])) if len(code) else np.zeros(0, np.int64)


def counted(code: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct sorted codes with the sums of their counts."""
    new = firsts(code)
    return code[new], np.add.reduceat(n, new)


MESSAGE = "depth int, bucket int, unit binary, runs binary, learned binary"


def _messages(depth: int, buckets: int):
    """A unit's distinct runs with their training counts, of the depths that
    serve all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for place, held in named(batches, lower=True):
            name, parts = place + digest(held), []
            while held:  # a slice is given back when its runs are known
                batch, w = held.pop()
                code, first = text_runs(*body(w), depth)
                train = batch.column("train").slice(w.row, w.n_docs).to_numpy(zero_copy_only=False)
                key = (code << 1) | np.repeat(train.astype(np.int64), np.diff(first))
                del batch, w, code, first, train
                key.sort()
                parts.append(counted(key >> 1, (key & 1).astype(np.int32)))
                del key
            code, learned = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
            del parts
            order = np.argsort(code, kind="stable")
            code, learned = counted(code[order], learned[order])
            del order
            levels, rows = Levels(code, depth, buckets), []
            for k in range(depth + 1):
                if listed_with(k, depth) != k:
                    continue
                level = levels.at(k)
                count, code = np.add.reduceat(learned, level.new)[level.order], level.run[level.order]
                for a, b in runs(level.bucket):
                    rows.append((k, int(level.bucket[a]), name, packed(np.diff(code[a:b], prepend=0)), packed(count[a:b])))
                del level, count, code
            del levels, learned
            kinds = (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)],
                names=["depth", "bucket", "unit", "runs", "learned"],
            )
            del rows
            release()

    return run


def _totals(least: int, depth: int):
    """Training counts of a bucket's runs, with those of their contexts and
    the number of symbols seen after them; of contexts that occur at least
    ``least`` times, where they are whole here."""
    schema = pa.schema([("depth", pa.int32()), ("run", pa.int64()), ("n", pa.int64()), ("total", pa.int64()), ("m", pa.int32())])

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        head, found = key[0].as_py(), []
        code = np.concatenate([np.cumsum(unpacked(x)) for x in table["runs"].to_pylist()])
        n = np.concatenate([unpacked(x) for x in table["learned"].to_pylist()])
        code, n = code[n > 0], n[n > 0]
        if not len(code):
            return schema.empty_table()
        order = np.argsort(code, kind="stable")
        longest, times = counted(code[order], n[order])
        del order
        for k in served(head, depth):
            code, n = counted(longest >> (8 * (head - k)), times)
            total, m = pa.nulls(len(code), pa.int64()), pa.nulls(len(code), pa.int32())
            if k > NEAR:
                _, where = np.unique(context_of(code, k), return_inverse=True)
                sums = np.bincount(where, weights=n).astype(np.int64)[where]
                kept = sums >= least
                total, m = pa.array(sums[kept]), pa.array(np.bincount(where)[where][kept], pa.int32())
                code, n = code[kept], n[kept]
            found.append(pa.table([pa.array(np.full(len(code), k), pa.int32()), pa.array(code), pa.array(n), total, m], schema=schema))
        return pa.concat_tables(found)

    return run


def context_column(k: int) -> Column:
    return F.col("run").bitwiseAND(F.lit((1 << (8 * k)) - 1))


def frequent(messages: DataFrame, depth: int, least: int, folder: str | None = None) -> list[DataFrame]:
    """For each context length: run, n, the context's total and its number m
    of next symbols, of the contexts that occur at least ``least`` times (the
    empty one always)."""
    sums = stored(
        messages.groupBy("depth", "bucket").applyInArrow(_totals(least, depth), "depth int, run long, n long, total long, m int"),
        folder,
    )
    found = []
    for k in range(depth + 1):
        level = sums.filter(F.col("depth") == k).select("run", "n", "total", "m")
        if k <= NEAR:  # at most 256 contexts
            totals = level.groupBy(context_column(k).alias("context")).agg(F.sum("n").alias("all"), F.count(F.lit(1)).alias("kinds"))
            level = level.join(F.broadcast(totals), context_column(k) == F.col("context")).filter(F.col("all") >= (least if k else 0))
            level = level.select("run", "n", F.col("all").alias("total"), F.col("kinds").cast("int").alias("m"))
        found.append(level)
    return found


def states(shares: list[DataFrame], folder: str | None = None) -> DataFrame:
    """Depth and context of the retained contexts."""
    kept = []
    for k in range(1, len(shares)):
        expected = shares[k - 1].select(F.col("run").alias("short"), (F.col("n") / F.col("total")).alias("expected"))
        both = shares[k].join(expected, F.shiftright("run", 8) == F.col("short"))
        bits = F.col("n") * F.log2(F.col("n") / F.col("total") / F.col("expected"))
        cost = (F.col("m") - 1) / 2 * F.log2("total") + 1
        # the cost of a context is spread over its symbols, so one sum is all that is grouped
        gain = both.select(context_column(k).alias("context"), (bits - cost / F.col("m")).alias("over"))
        far = gain.groupBy("context").agg(F.sum("over").alias("over")).filter(F.col("over") > 0)
        kept.append(far.select(F.lit(k).alias("depth"), "context"))
    far = stored(reduce(DataFrame.union, kept), folder)
    # a state and its shorter contexts
    each = F.explode(F.sequence(F.lit(0), F.col("depth") - 1)).alias("less")
    shorter = far.select("depth", "context", each).select(
        (F.col("depth") - F.col("less")).alias("depth"), F.expr("shiftright(context, 8 * less)").alias("context")
    )
    return stored(shorter.distinct(), folder)


#: A state's next symbol: log10 chance of the run, and log10 weight of the shorter context's chances.
MODEL = "head int, bucket int, depth int, run long, seen double, back double"


def model(shares: list[DataFrame], retained: DataFrame, folder: str | None = None) -> DataFrame:
    """Smoothed chances of the symbols seen after each state."""
    total = F.col("total") + 0.5 * SYMBOLS
    level = shares[0].select("run", ((F.col("n") + 0.5) / total).alias("p"))
    parts = [level.select(F.lit(0).alias("depth"), "run", F.log10("p").alias("seen"), F.lit(0.0).alias("back"))]
    for k in range(1, len(shares)):
        mine = retained.filter(F.col("depth") == k).select("context")
        rows = shares[k].join(mine, context_column(k) == F.col("context"), "left_semi")
        short = level.select(F.col("run").alias("short"), F.col("p").alias("before"))
        whole = F.col("total") + F.col("m")
        level = stored(
            rows.join(short, F.shiftright("run", 8) == F.col("short"))
            .select("run", ((F.col("n") + F.col("m") * F.col("before")) / whole).alias("p"), (F.col("m") / whole).alias("weight")),
            folder,
        )
        parts.append(level.select(F.lit(k).alias("depth"), "run", F.log10("p").alias("seen"), F.log10("weight").alias("back")))
    return reduce(DataFrame.union, parts)


def coded(asked: np.ndarray, k: int, run: np.ndarray, seen: np.ndarray, back: np.ndarray) -> np.ndarray:
    """For each asked run: its log10 chance (negative) if it was seen after a
    state; the negated weight of the shorter context (positive) if its context
    is a state after which it was not seen; 0 if its context is no state."""
    if not len(run):
        return np.zeros(len(asked))
    order = np.argsort(run)
    run, seen, back = run[order], seen[order], back[order]
    context, first = np.unique(context_of(run, k), return_index=True)
    mine = context_of(asked, k)
    at = np.minimum(np.searchsorted(context, mine), len(context) - 1)
    out = np.where(context[at] == mine, -back[first[at]], 0.0)
    hit = np.minimum(np.searchsorted(run, asked), len(run) - 1)
    return np.where(run[hit] == asked, seen[hit], out)


#: Values for a unit's runs of a depth in a bucket, or counts of its words.
ANSWER = "unit binary, depth int, bucket int, n int, values binary"
WORDS = -1


def _answers(depth: int):
    """Values of a bucket's runs, for the units that hold any of its states."""
    schema = pa.schema([("unit", pa.binary()), ("depth", pa.int32()), ("bucket", pa.int32()), ("n", pa.int32()), ("values", pa.binary())])

    def run(asked: pa.Table, table: pa.Table) -> pa.Table:
        if not len(asked) or not len(table):
            return schema.empty_table()
        head, bucket, rows = asked["depth"][0].as_py(), asked["bucket"][0].as_py(), []
        names, whole = asked["unit"].to_pylist(), [np.cumsum(unpacked(x)) for x in asked["runs"].to_pylist()]
        mine, columns = table["depth"].to_numpy(), [table[c].to_numpy() for c in ("run", "seen", "back")]
        begin = np.cumsum([0] + [len(c) for c in whole])
        for k in served(head, depth):
            short = [c >> (8 * (head - k)) for c in whole]
            new = [firsts(c) for c in short]
            ends = np.cumsum([0] + [len(x) for x in new])
            value = coded(np.concatenate([c[x] for c, x in zip(short, new, strict=True)]), k, *(c[mine == k] for c in columns)).astype("<f4")
            if k == head:
                unseen = value >= 0
            else:  # a shorter run whose longer ones were all seen after states is not asked for
                at = np.concatenate([x + b for x, b in zip(new, begin[:-1], strict=True)])
                value[~np.logical_or.reduceat(unseen, at)] = 0
            rows += [
                (unit, k, bucket, b - a, zlib.compress(value[a:b].tobytes(), 1))
                for unit, a, b in zip(names, ends[:-1].tolist(), ends[1:].tolist(), strict=True) if value[a:b].any()
            ]
        release()
        return pa.Table.from_pylist([dict(zip(schema.names, r, strict=True)) for r in rows], schema=schema)

    return run


def _laid_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bytes of the texts of each slice of a unit, compressed, with their ids,
    sizes and numbers of words."""
    for begin, held in named(batches, lower=True):
        name = begin + digest(held)
        for k, (batch, w) in enumerate(held):
            data, off = body(w)
            ids = batch.column("id").slice(w.row, w.n_docs)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([name], pa.binary()), pa.array([k], pa.int32()), pa.ListArray.from_arrays(pa.array([0, w.n_docs], pa.int32()), ids),
                    pa.array([packed(np.diff(w.first))], pa.binary()), pa.array([packed(np.diff(off))], pa.binary()),
                    pa.array([zlib.compress(data.tobytes(), 1)], pa.binary()),
                ],
                names=["unit", "slice", "ids", "words", "sizes", "body"],
            )
        release()


Held = dict[tuple[int, int], tuple[int, bytes]]


def answered(held: Held, k: int, bucket: np.ndarray) -> Iterator[tuple[int, int, bytes | None]]:
    """Ranges of a sorted list of buckets, and what each of them answered."""
    for a, b in runs(bucket):
        n, raw = held.get((k, int(bucket[a])), (b - a if k != WORDS else -1, None))
        if n != b - a:
            raise RuntimeError("the texts were not the same when read again; write them to a table before scoring")
        yield a, b, raw


def values_of(whole: np.ndarray, held: Held, depth: int, buckets: int, near: list[tuple], unseen: float) -> np.ndarray:
    """Log10 chance of the symbol of each distinct run of a unit."""
    levels = Levels(whole, depth, buckets)
    value, back = np.full(len(whole), np.nan), np.zeros(len(whole))
    for k in range(depth, -1, -1):
        level = levels.at(k)
        if k <= NEAR:
            got = coded(level.run, k, *near[k])
            if not k:  # the root knows all symbols
                got = np.where(got < 0, got, unseen)
        else:
            listed = np.zeros(len(level.run))
            for a, b, raw in answered(held, k, level.bucket):
                if raw is not None:
                    listed[a:b] = np.frombuffer(zlib.decompress(raw), "<f4")
            got = np.empty(len(listed))
            got[level.order] = listed
        mine = np.repeat(got, np.diff(np.append(level.new, len(whole))))
        del level, got
        open_ = np.isnan(value)
        value = np.where(open_ & (mine < 0), back + mine, value)
        back = np.where(open_ & (mine > 0), back - mine, back)
    return value


def by_bucket(word: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Order by bucket, then by hash, of distinct sorted words, and the buckets
    so ordered."""
    bucket = (word % U64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    return order, bucket[order]


def numbered(code: np.ndarray, kind: str | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct sorted codes, and the place of each code among them."""
    order = np.argsort(code, kind=kind)
    code = code[order]
    new = np.concatenate([np.ones(min(1, len(code)), bool), code[1:] != code[:-1]])
    where = np.empty(len(code), np.int32)
    where[order] = np.cumsum(new, dtype=np.int32) - 1
    return code[new], where


def _chances(laid: list[tuple[np.ndarray, np.ndarray]], held: Held, depth: int, buckets: int, near: tuple) -> np.ndarray:
    """Log10 chance of each text of a unit, given as bytes and offsets."""
    sorted_, parts, at = [], [], 0
    for data, off in laid:
        code, first = text_runs(data, off, depth)
        for a in range(0, len(first) - 1, TEXTS):
            b = min(a + TEXTS, len(first) - 1)
            key = code[first[a] : first[b]].view(U64) << U64(8)
            key |= np.repeat(np.arange(b - a, dtype=U64), np.diff(first[a : b + 1]))
            key.sort()
            text = (key & U64(TEXTS - 1)).astype(np.uint8)
            key >>= U64(8)
            new = firsts(key)
            sorted_.append((key[new].view(np.int64), np.diff(np.append(new, len(key))).astype(np.int32), text, b - a))
            del key, new, text
        del code
    whole, where = numbered(np.concatenate([u for u, _, _, _ in sorted_]), "stable")  # merges sorted runs
    value = values_of(whole, held, depth, buckets, *near)
    for u, times, text, n in sorted_:  # a text's runs are added up in their order, so equal texts have equal sums
        parts.append(np.bincount(text, weights=np.repeat(value[where[at : at + len(u)]], times), minlength=n))
        at += len(u)
    return np.concatenate(parts)


def _bases(laid: list[tuple[np.ndarray, np.ndarray]], held: Held, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """For each text of a unit: the sum of log10(c + 0.1) over its words, and
    how many of them have a training count c."""
    texts = [pa.LargeStringArray.from_buffers(len(off) - 1, pa.py_buffer(off), pa.py_buffer(data)) for data, off in laid]
    words = [w for column in texts for w in split_words(column)]
    word, where = numbered(np.concatenate([word_hash(w) for w in words]))
    order, bucket = by_bucket(word, buckets)
    listed = np.zeros(len(word), np.int64)
    for a, b, raw in answered(held, WORDS, bucket):
        listed[a:b] = unpacked(raw)
    c = np.empty(len(word), np.int64)
    c[order] = listed
    value, known, at, parts = np.log10(c + 0.1), c > 0, 0, []
    for w in words:
        mine = where[at : at + len(w.start)]
        parts.append([np.bincount(w.doc, weights=x[mine], minlength=w.n_docs) for x in (value, known)])
        at += len(mine)
    base, seen = (np.concatenate(x) for x in zip(*parts, strict=True))
    return base, seen.astype(np.int64)


def _summed(depth: int, buckets: int, near):
    """Base and log10 chance of each text of a unit, from the answers for its
    words and runs."""

    def run(laid: pa.Table, answers: pa.Table) -> pa.Table:
        laid = laid.sort_by("slice")
        held: Held = {(r["depth"], r["bucket"]): (r["n"], r["values"]) for r in answers.to_pylist()}
        texts = [
            (np.frombuffer(zlib.decompress(raw), np.uint8), np.concatenate([[0], np.cumsum(unpacked(sizes))]))
            for sizes, raw in zip(laid["sizes"].to_pylist(), laid["body"].to_pylist(), strict=True)
        ]
        ids = laid["ids"].combine_chunks().flatten()
        words = np.concatenate([np.zeros(0, np.int64), *map(unpacked, laid["words"].to_pylist())])
        base, known, score = np.zeros(0), np.zeros(0, np.int64), np.zeros(0)
        if len(ids):
            base, known = _bases(texts, held, buckets)
            score = _chances(texts, held, depth, buckets, near.value)
        del held, texts
        release()
        return pa.table({"id": ids, "words": pa.array(words, pa.int64()), "base": base, "known": known, "score": score})

    return run


def _learned(buckets: int):
    """For each bucket of a unit: its distinct words' hashes and training
    counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for place, held in named(batches, lower=True):
            name, parts = place + digest(held), []
            while held:
                batch, w = held.pop()
                h, train = word_hash(w), batch.column("train").slice(w.row, w.n_docs).to_numpy(zero_copy_only=False)
                parts.append((h, h[np.repeat(train, np.diff(w.first))]))
                del batch, w
            word = np.unique(np.concatenate([h for h, _ in parts]))
            trained, times = np.unique(np.concatenate([h for _, h in parts]), return_counts=True)
            del parts
            n = np.zeros(len(word), np.int64)
            n[np.searchsorted(word, trained)] = times
            order, bucket = by_bucket(word, buckets)
            word, n = word[order], n[order]
            rows = [(int(bucket[a]), name, word[a:b].tobytes(), packed(n[a:b])) for a, b in runs(bucket)]
            del word, n, order, bucket, trained, times
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int32(), pa.binary(), pa.binary(), pa.binary()))],
                names=["bucket", "unit", "words", "learned"],
            )
            del rows
            release()

    return run


def _counts(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """Corpus counts of a bucket's words, for each unit those of its words, and
    one row with the bucket's totals."""
    words = [np.frombuffer(x, "<u8") for x in table["words"].to_pylist()]
    u, where = np.unique(np.concatenate(words), return_inverse=True)
    c = np.bincount(where, weights=np.concatenate([unpacked(x) for x in table["learned"].to_pylist()]), minlength=len(u)).astype(np.int64)
    ends, n = np.cumsum([0] + [len(x) for x in words]).tolist(), len(words)
    return pa.table(
        {
            "unit": pa.array([None, *table["unit"].to_pylist()], pa.binary()), "depth": pa.array([WORDS] * (n + 1), pa.int32()),
            "bucket": pa.array([key[0].as_py()] * (n + 1), pa.int32()), "n": pa.array([0, *map(len, words)], pa.int32()),
            "values": pa.array([None, *(packed(c[where[a:b]]) for a, b in zip(ends[:-1], ends[1:], strict=True))], pa.binary()),
            "tokens": pa.array([int(c.sum())] + [0] * n, pa.int64()), "kinds": pa.array([int((c > 0).sum())] + [0] * n, pa.int64()),
        }
    )


def score(
    docs: DataFrame, folds: int = 10, depth: int = DEPTH, least: int = LEAST, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """For each document: ``id_col``, ``held_out``, ``n_tokens``, ``n_known``,
    ``train_tokens``, ``base_score`` and ``score``, the last two log10."""
    if not NEAR < depth <= 6:
        raise ValueError(f"{NEAR} < depth <= 6 is needed")
    with bounded_batches(docs.sparkSession):
        return _score(docs, folds, depth, least, id_col, text_col)


def chances(texts: DataFrame, depth: int, least: int, buckets: int) -> tuple[DataFrame, tuple]:
    """Answers to all units, and what every worker knows: the states of the
    shortest contexts and the root's chance of a symbol that it never saw.

    The answers are written, so the messages, the tables of the tree and the
    shuffles that brought them together do not stay on disk beside what
    follows."""
    with passing_folder(texts.sparkSession) as folder:
        messages = stored(texts.select("text", "train").mapInArrow(_messages(depth, buckets), MESSAGE), folder)
        shares = frequent(messages, depth, least, folder)
        rows = model(shares, states(shares, folder), folder)
        near = rows.filter(F.col("depth") <= NEAR).toPandas()
        parts = [near[near["depth"] == k].sort_values("run") for k in range(NEAR + 1)]
        known = [tuple(p[c].to_numpy() for c in ("run", "seen", "back")) for p in parts]
        places = shares[0].agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
        unseen = math.log10(0.5 / (places + 0.5 * SYMBOLS))
        asked = messages.filter(F.col("depth") > NEAR).select("depth", "bucket", "unit", "runs")
        deep = rows.filter(F.col("depth") > NEAR).mapInArrow(_with_bucket(depth, buckets), MODEL)
        answers = asked.groupBy("depth", "bucket").cogroup(deep.groupBy("head", "bucket")).applyInArrow(_answers(depth), ANSWER)
        return stored(answers), (known, unseen)


def _with_bucket(depth: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            level, code = batch.column("depth").to_numpy(), batch.column("run").to_numpy()
            head, bucket = np.zeros(len(code), np.int32), np.zeros(len(code), np.int64)
            for k in np.unique(level).tolist():
                head[level == k] = listed_with(k, depth)
                bucket[level == k] = bucket_of(code[level == k], k, depth, buckets)
            yield pa.RecordBatch.from_arrays(
                [pa.array(head), pa.array(bucket, pa.int32()), *batch.columns], names=["head", "bucket", "depth", "run", "seen", "back"]
            )

    return run


def _score(docs: DataFrame, folds: int, depth: int, least: int, id_col: str, text_col: str) -> DataFrame:
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType.simpleString()
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), (~held_out(F.col(id_col), folds)).alias("train"))
    n, trained = texts.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.col("train").cast("long")), F.lit(0))).first()
    buckets = max(LEAST_BUCKETS, n // TEXTS_A_BUCKET)
    chance, near = chances(texts, depth, least, buckets)
    known = spark.sparkContext.broadcast(near)
    asked = texts.select("text", "train").mapInArrow(_learned(buckets), "bucket int, unit binary, words binary, learned binary")
    counts = stored(asked.groupBy("bucket").applyInArrow(_counts, f"{ANSWER}, tokens long, kinds long"))
    tokens, kinds = counts.agg(F.coalesce(F.sum("tokens"), F.lit(0)), F.coalesce(F.sum("kinds"), F.lit(0))).first()
    tokens, kinds = tokens + trained, kinds + (trained > 0)
    answers = chance.union(counts.filter("unit is not null").select(*chance.columns))
    laid = texts.select("id", "text").mapInArrow(
        _laid_out, f"unit binary, slice int, ids array<{kind}>, words binary, sizes binary, body binary"
    )
    scored = (
        laid.groupBy("unit").cogroup(answers.groupBy("unit"))
        .applyInArrow(_summed(depth, buckets, known), f"id {kind}, words long, base double, known long, score double")
    )
    n_tokens = F.col("words") + 1
    return scored.select(
        F.col("id").alias(id_col), held_out(F.col("id"), folds).alias("held_out"), n_tokens.alias("n_tokens"),
        (F.col("known") + int(trained > 0)).cast("long").alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("base") + math.log10(trained + 0.1) - n_tokens * math.log10(tokens + 0.1 * (kinds + 1))).alias("base_score"), "score",
    )
