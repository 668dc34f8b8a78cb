"""Quality rules by distribution divergence (operator 9).

References are learned from the whole corpus, one for each language of at
least ``LEAST_WORDS`` words: the shares of character classes, and the shares
of its ``COMMON`` most frequent words, all other words together being one bin.
A document's own histograms are compared with its language's reference by
Jensen-Shannon divergence (base 2, from 0 to 1), so its verdict depends on no
other language.  A document whose language has no reference gets divergences
of 0.  A document is rejected if it fails a base rule (too few words, too many
words in repeated windows), or if it has at least ``min_words`` words and one
of the divergences passes its limit.  Shorter documents have too much noise in
their histograms for a verdict and are kept.

References of languages with a thousandth of all words (at most a thousand)
are broadcast to the workers; those of the others are joined to their
documents.  That changes the way they travel, not what they judge.

Defined cases: null and empty texts have no words and fail the base rule; a
null language is a language of its own; documents of languages below
``LEAST_WORDS`` words are not rejected for divergence; ties among common words go to the
smaller word; equal rows get equal results.  Only id, text and language are
read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from quantis.llm.vocabulary import Vocabulary, summed
from quantis.llm.wordbatch import IS_SPACE, LOWER_AZ, U64, Words, bytes_hash, inside, mix, run_hash, same_bytes, split_words, word_hash
from quantis.llm.work import cut

COMMON = 64
#: Share of all words that makes a language large, and words that any needs for a reference.
LEAST_SHARE, LEAST_WORDS = 0.001, 2_000
#: References (of about 1 KB) of other languages that are broadcast; more are joined with salt.
BROADCAST, SALTS = 10_000, 16
BUCKETS = 256

# Character classes by byte.
CLASSES = ("other ascii", "lower", "upper", "digit", "white space", "punctuation", "symbol", "non-ascii")
CLASS_OF = np.zeros(256, np.int64)
CLASS_OF[97:123], CLASS_OF[65:91], CLASS_OF[48:58] = 1, 2, 3
CLASS_OF[IS_SPACE] = 4
CLASS_OF[list(b".,;:!?'\"()-")] = 5
CLASS_OF[list(b"#*$%&|<>")] = 6
CLASS_OF[128:] = 7
SYMBOLS = CLASS_OF == 6


def per_document(flags: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of the flags in each document's range."""
    return np.diff(np.concatenate([[0], np.cumsum(flags)])[first])


def class_histogram(w: Words) -> np.ndarray:
    """Bytes of each class in each document."""
    c = CLASS_OF[w.data]
    return np.stack([per_document(c == k, w.offsets) for k in range(len(CLASSES))], axis=1)


def lowered(w: Words) -> Words:
    return Words(w.row, LOWER_AZ[w.data], w.offsets, w.start, w.end, w.first)


def doubled(doc: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which hashes occur again in their document, and which occur after an
    equal one."""
    key = mix(h ^ mix(doc.astype(U64) + U64(1)))
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    again, later = np.zeros(len(h), bool), np.zeros(len(h), bool)
    later[order[1:][same]] = True
    again[order[:-1][same]] = True
    return again | later, later


def repeated_words(w: Words, h: np.ndarray, window: int) -> np.ndarray:
    """Words of each document in windows that the document holds twice."""
    at = np.flatnonzero(inside(w.first, window, len(h)))
    if not len(at):
        return np.zeros(w.n_docs, np.int64)
    twice, _ = doubled(w.doc[at], run_hash(h, window)[at])
    cover = np.zeros(len(h) + 1, np.int64)
    cover[at[twice]] += 1
    np.add.at(cover, at[twice] + window, -1)
    return per_document(np.cumsum(cover[:-1]) > 0, w.first)


def duplicate_lines(w: Words) -> np.ndarray:
    """Lines of each document that hold a word and equal an earlier line."""
    feed = np.flatnonzero(w.data == 0x0A)
    start = np.unique(np.concatenate([w.offsets[:-1], feed + 1]))
    start = start[start < len(w.data)]
    end = np.append(start[1:], len(w.data))
    doc = np.searchsorted(w.offsets, start, side="right") - 1
    end = np.where((end > start) & (w.data[end - 1] == 0x0A), end - 1, end)
    words = np.searchsorted(w.start, end) - np.searchsorted(w.start, start)
    keep = words > 0
    start, end, doc = start[keep], end[keep], doc[keep]
    h = bytes_hash(w.data, start, end)
    _, first, group = np.unique(mix(h ^ mix(doc.astype(U64) + U64(1))), return_index=True, return_inverse=True)
    later = np.flatnonzero(first[group] != np.arange(len(group)))
    lead = first[group[later]]
    equal = (doc[later] == doc[lead]) & same_bytes(w.data, (start[later], end[later]), (start[lead], end[lead]))
    found = np.bincount(doc[later[equal]], minlength=w.n_docs)
    for d in np.unique(doc[later[~equal]]).tolist():  # lines that share a hash without being equal
        lines = [w.data[a:b].tobytes() for a, b in zip(start[doc == d], end[doc == d], strict=True)]
        found[d] = len(lines) - len(set(lines))
    return found


def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Word counts and character classes of the task's texts, by language."""
    held: dict[str | None, Vocabulary] = {}
    classes: dict[str | None, np.ndarray] = {}

    def rows() -> Iterator[pa.RecordBatch]:
        for lang, words in held.items():
            parts = list(words.by_bucket(BUCKETS))
            yield pa.RecordBatch.from_pydict(
                {
                    "bucket": pa.array([-1] + [p[0] for p in parts], pa.int32()), "lang": pa.array([lang] * (len(parts) + 1), pa.string()),
                    "words": pa.array([b""] + [p[3].tobytes() for p in parts], pa.binary()),
                    "counts": pa.array([classes[lang].tobytes()] + [p[2].astype("<i8").tobytes() for p in parts], pa.binary()),
                }
            )
        held.clear()
        classes.clear()

    for batch in batches:
        langs = np.array(batch.column("lang").to_pylist(), dtype=object)
        for w in split_words(batch.column("text")):
            hist, here, low = class_histogram(w), langs[w.row : w.row + w.n_docs], lowered(w)
            h, doc = word_hash(low), w.doc
            for lang in set(here.tolist()):
                mine = here == lang
                held.setdefault(lang, Vocabulary()).add(low, h, np.flatnonzero(mine[doc]))
                classes[lang] = classes.get(lang, 0) + hist[mine].sum(axis=0)
        if sum(v.held for v in held.values()) > 3_000_000:
            yield from rows()
    yield from rows()


def _most_frequent(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums one bucket of one language; keeps its ``COMMON`` most frequent
    words and the total."""
    bucket, lang = key[0].as_py(), key[1].as_py()
    classes = np.zeros(len(CLASSES), np.int64)
    spelled, parts = Vocabulary(), []
    for batch in batches:
        for raw, counts in zip(batch.column("words").to_pylist(), batch.column("counts").to_pylist(), strict=True):
            n = np.frombuffer(counts, "<i8")
            if bucket < 0:
                classes = classes + n
                continue
            for w in split_words(pa.array([raw.decode()]), limit=len(raw) + 1):
                h = word_hash(w)
                spelled.add(w, h)
                parts.append((h, n))
        if len(parts) > 64:
            parts = [summed(parts)]
    if bucket < 0:
        yield pa.RecordBatch.from_pydict(
            {"lang": pa.array([lang], pa.string()), "word": pa.array([None], pa.string()), "n": pa.array([0], pa.int64()),
             "total": pa.array([0], pa.int64()), "classes": pa.array([classes.tolist()], pa.list_(pa.int64()))}
        )
    elif parts:
        _, n = summed(parts)
        _, _, data, off = spelled.distinct()
        words = [data[off[i] : off[i + 1]].tobytes().decode() for i in np.flatnonzero(n >= np.sort(n)[-min(COMMON, len(n))])]
        count = n[n >= np.sort(n)[-min(COMMON, len(n))]]
        best = sorted(zip(-count, words, strict=True))[:COMMON]
        yield pa.RecordBatch.from_pydict(
            {"lang": pa.array([lang] * len(best), pa.string()), "word": pa.array([x[1] for x in best], pa.string()),
             "n": pa.array([-int(x[0]) for x in best], pa.int64()),
             "total": pa.array([int(n.sum())] + [0] * (len(best) - 1), pa.int64()),
             "classes": pa.nulls(len(best), pa.list_(pa.int64()))}
        )


@dataclass
class References:
    """Shares of the character classes (one row a reference), and the common
    words' hashes with the shares of them and of all other words."""

    langs: list[str | None]
    classes: np.ndarray
    words: list[np.ndarray]
    shares: list[np.ndarray]


def _packed(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A language's reference in one value."""
    rows = sorted((r for b in batches for r in b.to_pylist()), key=lambda r: (-r["n"], r["word"] or ""))
    hist = next(np.array(r["classes"], float) for r in rows if r["word"] is None)
    common, total = [r for r in rows if r["word"] is not None], rows[0]["total"]
    w = next(split_words(pa.array([" ".join(r["word"] for r in common)])))
    n = np.array([r["n"] for r in common], float)
    shares = np.append(n, total - n.sum()) / total
    raw = (hist / hist.sum()).astype("<f8").tobytes() + word_hash(w).astype("<u8").tobytes() + shares.astype("<f8").tobytes()
    yield pa.RecordBatch.from_pydict(
        {"lang": pa.array([key[0].as_py()], pa.string()), "total": pa.array([total], pa.int64()), "own": pa.array([raw], pa.binary())}
    )


def unpacked(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shares of classes, hashes of common words, and their shares."""
    at = 8 * len(CLASSES)
    k = (len(raw) - at) // 16  # one more share than words
    return np.frombuffer(raw[:at], "<f8"), np.frombuffer(raw[at : at + 8 * k], "<u8"), np.frombuffer(raw[at + 8 * k :], "<f8")


def reference_table(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    """One row for each common word of each language, and one (word null) with
    the language's character classes: lang, word, n, total, classes."""
    narrow = docs.select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    found = (
        narrow.mapInArrow(_gather, "bucket int, lang string, words binary, counts binary")
        .groupBy("bucket", "lang")
        .applyInArrow(_most_frequent, "lang string, word string, n long, total long, classes array<long>")
    )
    by_lang = W.partitionBy("lang")
    ranked = found.withColumn("total", F.sum("total").over(by_lang)).withColumn(
        "place", F.row_number().over(by_lang.orderBy(F.col("word").isNotNull(), F.desc("n"), "word"))
    )
    return ranked.filter(F.col("place") <= COMMON + 1).drop("place")


def references(docs: DataFrame, text_col: str, lang_col: str) -> tuple[References, DataFrame, int]:
    """References of the large languages, and those of the others as a table
    (lang, own) with its number of rows."""
    table = cut(reference_table(docs, text_col, lang_col))
    everything = table.filter("word is null").agg(F.sum("total")).first()[0] or 0
    found = cut(
        table.filter(F.col("total") >= LEAST_WORDS).groupBy("lang").applyInArrow(_packed, "lang string, total long, own binary")
    )
    is_large = F.col("total") >= everything * LEAST_SHARE
    rows = sorted(found.filter(is_large).collect(), key=lambda r: (r["lang"] is None, r["lang"] or ""))
    parts = [unpacked(bytes(r["own"])) for r in rows]
    classes = np.array([p[0] for p in parts]).reshape(-1, len(CLASSES))
    others = found.filter(~is_large).select("lang", "own")
    return References([r["lang"] for r in rows], classes, [p[1] for p in parts], [p[2] for p in parts]), others, others.count()


def with_own(texts: DataFrame, others: DataFrame, n: int) -> DataFrame:
    """Adds the reference ``own`` of each row's language ``lang``, null if the
    language is large or has none."""
    if not n:
        return texts.withColumn("own", F.lit(None).cast("binary"))
    named = others.withColumnRenamed("lang", "name")
    same = F.col("lang").eqNullSafe(F.col("name"))
    if n <= BROADCAST:
        return texts.join(F.broadcast(named), same, "left").drop("name")
    salted = named.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    spread = texts.withColumn("at", F.pmod(F.xxhash64("id", "text"), F.lit(SALTS)).cast("int"))
    return spread.join(salted, same & (F.col("at") == F.col("salt")), "left").drop("name", "salt", "at")


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon divergence (base 2) of each row of ``p`` from ``q``."""
    m = (p + q) / 2

    def part(a: np.ndarray) -> np.ndarray:
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(a > 0, a * np.log2(a / m), 0.0).sum(axis=1)

    return (part(p) + part(np.broadcast_to(q, p.shape))) / 2


def divergences(w: Words, hist: np.ndarray, ref: References, lang: np.ndarray, own: list) -> tuple[np.ndarray, np.ndarray]:
    """Divergence of each document from its language's reference: classes,
    words.  ``lang`` is its place in ``ref`` (-1: not there), ``own`` a packed
    reference that came with the document; without either the result is 0."""
    n = np.diff(w.first)
    by_class, by_word = np.zeros(w.n_docs), np.zeros(w.n_docs)
    h, doc = word_hash(lowered(w)), w.doc

    def compare(some: np.ndarray, q: np.ndarray, known: np.ndarray, share: np.ndarray) -> None:
        rows = np.flatnonzero(some)
        number = np.cumsum(some) - 1
        mine = some[doc]
        heard, place = h[mine], number[doc[mine]]
        by_class[rows] = divergence(hist[rows] / hist[rows].sum(axis=1, keepdims=True), q)
        order = np.argsort(known)
        at = np.minimum(np.searchsorted(known[order], heard), len(known) - 1)
        bin_ = np.where(known[order][at] == heard, order[at], len(known))
        counts = np.bincount(place * len(share) + bin_, minlength=len(rows) * len(share)).reshape(len(rows), -1)
        by_word[rows] = divergence(counts / n[rows, None], share)

    for k in np.unique(lang[(lang >= 0) & (n > 0)]).tolist():
        compare((lang == k) & (n > 0), ref.classes[k], ref.words[k], ref.shares[k])
    groups: dict[bytes, list[int]] = {}
    for i in np.flatnonzero((lang < 0) & (n > 0)).tolist():
        if own[i] is not None:
            groups.setdefault(own[i], []).append(i)
    for raw, rows in groups.items():
        mine = np.zeros(w.n_docs, bool)
        mine[rows] = True
        compare(mine, *unpacked(raw))
    return by_class, by_word


def _profile(window: int, ref):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = {x: k for k, x in enumerate(ref.value.langs)}
            lang = np.array([place.get(x, -1) for x in batch.column("lang").to_pylist()], np.int64)
            own = batch.column("own").to_pylist()
            for w in split_words(batch.column("text")):
                h, hist = word_hash(w), class_histogram(w)
                space = per_document(IS_SPACE[w.data], w.offsets)
                points = per_document((w.data & 0xC0) != 0x80, w.offsets)
                by_class, by_word = divergences(w, hist, ref.value, lang[w.row : w.row + w.n_docs], own[w.row : w.row + w.n_docs])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(w.row, w.n_docs)]
                    + [
                        pa.array(x, pa.int64())
                        for x in (np.diff(w.first), points - space, per_document(SYMBOLS[w.data], w.offsets), duplicate_lines(w), repeated_words(w, h, window))
                    ]
                    + [pa.array(by_class), pa.array(by_word)],
                    names=["id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "class_jsd", "word_jsd"],
                )

    return run


def judge(
    docs: DataFrame, window: int = 8, least_words: int = 20, repeat_percent: int = 30, min_words: int = 50,
    class_limit: float = 0.10, word_limit: float = 0.20, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
) -> DataFrame:
    """Counts, divergences and verdict (``base_failed``, ``kept``) of each
    document."""
    large, others, n = references(docs, text_col, lang_col)
    ref = docs.sparkSession.sparkContext.broadcast(large)
    kind = docs.schema[id_col].dataType.simpleString()
    schema = (
        f"id {kind}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
        "class_jsd double, word_jsd double"
    )
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    out = with_own(texts, others, n).mapInArrow(_profile(window, ref), schema)
    failed = (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > repeat_percent * F.col("n_words"))
    far = (F.col("n_words") >= min_words) & ((F.col("class_jsd") > class_limit) | (F.col("word_jsd") > word_limit))
    return out.withColumn("base_failed", failed).withColumn("kept", ~failed & ~far).withColumnRenamed("id", id_col)
