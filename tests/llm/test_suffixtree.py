"""Language-model scoring against a suffix tree built from dictionaries."""

import collections
import math
import os
import random
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quantis.llm import suffixtree
from quantis.session import ensure_checkpoint_dir
from tests.llm.conftest import LOWER, words
from tests.llm.test_operators_on_odd_rows import collected


def brute_base(rows):
    text = [(r[0], [*(w for w in words((r[1] or "").translate(LOWER))), None]) for r in rows]
    out = [zlib.crc32(str(i if i is not None else "").encode()) % 10 == 0 for i, _ in text]
    c = collections.Counter(t for (_, ts), o in zip(text, out) if not o for t in ts)
    n, v = sum(c.values()), len(c)
    d = math.log10(n + 0.1 * (v + 1))
    return [(i, o, len(t), sum(c[x] > 0 for x in t), n, sum(math.log10(c[x] + 0.1) - d for x in t)) for (i, t), o in zip(text, out)]


def brute_tree(texts, depth=6, least=10):
    """Chance of a next byte after a context, by the rules of the module:
    counts, divergence test, Witten-Bell smoothing along the suffixes."""
    counts = [collections.defaultdict(collections.Counter) for _ in range(depth + 1)]
    for t in texts:
        s = b"\n" * depth + t + b"\n"
        for p in range(depth, len(s)):
            for k in range(depth + 1):
                counts[k][s[p - k : p]][s[p]] += 1
    total = [{c: sum(n.values()) for c, n in level.items()} for level in counts]
    kept = {b""}
    for k in range(1, depth + 1):
        for c, n in counts[k].items():
            if total[k][c] < least:
                continue
            short, whole = counts[k - 1][c[1:]], total[k - 1][c[1:]]
            gain = sum(x * math.log2(x / total[k][c] / (short[s] / whole)) for s, x in n.items())
            if gain > (len(n) - 1) / 2 * math.log2(total[k][c]) + 1:
                kept |= {c[j:] for j in range(k)}

    def chance(context, symbol):
        if context not in kept:
            return chance(context[1:], symbol)
        k = len(context)
        n, all_ = counts[k].get(context, {}), total[k].get(context, 0)
        if not k:
            return (n.get(symbol, 0) + 0.5) / (all_ + 128)
        m = len(n)
        return (n.get(symbol, 0) + m * chance(context[1:], symbol)) / (all_ + m)

    return chance, kept


def brute_score(chance, text, depth=6):
    s = b"\n" * depth + text + b"\n"
    return sum(math.log10(chance(s[p - depth : p], s[p])) for p in range(depth, len(s)))


def normalised(text):
    return " ".join(words((text or "").translate(LOWER))).encode()


def brute_rows(rows, depth=6, least=10):
    out = [zlib.crc32(str(r[0] if r[0] is not None else "").encode()) % 10 == 0 for r in rows]
    chance, _ = brute_tree([normalised(r[1]) for r, o in zip(rows, out, strict=True) if not o], depth, least)
    known = {}
    return [(*b, known.setdefault(r[1], None) or known.__setitem__(r[1], brute_score(chance, normalised(r[1]), depth)) or known[r[1]])
            for b, r in zip(brute_base(rows), rows, strict=True)]


def agree(got, expected):
    key = lambda r: (r[0] is None, r[0] or 0, r[2], r[5])
    for g, e in zip(sorted(got, key=key), sorted(expected, key=key), strict=True):
        assert g[:5] == e[:5] and g[5] == pytest.approx(e[5], rel=1e-9) and g[6] == pytest.approx(e[6], rel=1e-6), (g, e)


@pytest.mark.parametrize("table", ["odd", "clashing"])
def test_scores_on_odd_rows(request, odd_rows, table):
    agree(collected(suffixtree.score(request.getfixturevalue(table))), brute_rows(odd_rows))


@pytest.mark.parametrize("depth, least", [(6, 10), (3, 2)])
def test_scores_on_texts_of_many_scripts(spark, depth, least):
    rng = random.Random(4)
    parts = ["ka", "lo", "mi", "the ", "ing ", "re", " ", "да", "нет ", "日本", "語 ", "é", "😀", "12", "Q", "\n", "x-", "\x00", "\x7f"]
    rows = [(i, "".join(rng.choices(parts, k=rng.randrange(0, 120)))) for i in range(150)] + [(7, "repeated ka"), (7, "repeated ka"), (91, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    agree(collected(suffixtree.score(df, depth=depth, least=least)), brute_rows(rows, depth, least))


def test_every_state_is_a_distribution():
    rng = random.Random(6)
    chance, kept = brute_tree([bytes(rng.choices(b"abcd ", k=400)) for _ in range(5)] + [b"abab" * 200], 4, 3)
    assert len(kept) > 5
    for c in kept:
        assert sum(chance(c, s) for s in range(256)) == pytest.approx(1)


def test_rare_contexts_stay_states_however_large_the_corpus_is(spark):
    rows = [(100 + i, "ab ba " * 20000) for i in range(60)] + [(i, "zq " * 2) for i in range(8)]  # zq: 16 of 7.2 million places
    read = spark.createDataFrame(rows, "doc_id long, text string").select("text", F.lit(True).alias("train"))
    messages = read.mapInArrow(suffixtree._messages(6, 64), suffixtree.MESSAGE)
    found = suffixtree.states(suffixtree.frequent(messages, 6, 10))
    assert found.filter((F.col("depth") == 1) & (F.col("context") == ord("z"))).count() == 1


def test_no_bucket_gets_the_runs_of_a_frequent_context():
    """All runs share their newest three symbols; their contexts spread them."""
    rng = np.random.default_rng(1)
    older = np.unique(rng.integers(0, 1 << 24, 60_000))
    whole = np.sort((ord("e") << 48) | (ord("t") << 40) | (ord("h") << 32) | (ord(" ") << 24) | older)
    levels = suffixtree.Levels(whole, 6, 64)
    for k in (5, 6):
        assert np.bincount(levels.bucket[k]).max() < 2 * len(levels.run[k]) / 64


@pytest.mark.parametrize("depth", [2, 3, 4, 5, 6])
def test_lists_of_longer_runs_hold_the_shorter_ones(depth):
    heads = {suffixtree.listed_with(k, depth) for k in range(depth + 1)}
    assert sorted(k for h in heads for k in suffixtree.served(h, depth)) == list(range(depth + 1))
    whole = np.unique(np.random.default_rng(3).integers(0, 1 << 8 * (depth + 1), 5_000))
    for h in heads:
        long = np.unique(whole >> (8 * (depth - h)))
        for k in suffixtree.served(h, depth):
            short = long >> (8 * (h - k))
            assert (suffixtree.bucket_of(long, h, depth, 64) == suffixtree.bucket_of(short, k, depth, 64)).all()


def test_a_units_lists_are_less_than_twice_its_texts():
    rng = random.Random(8)
    vocabulary = ["".join(rng.choices("etaoinshrdlu", k=rng.randrange(2, 9))) for _ in range(4_000)]
    texts = [" ".join(rng.choices(vocabulary, k=400)) for _ in range(400)]
    batch = pa.RecordBatch.from_pydict({"text": texts, "train": [True] * len(texts)})
    sent = list(suffixtree._messages(6, 64)(iter([batch])))
    assert {k for b in sent for k in b["depth"].to_pylist()} == {0, 1, 2, 4, 6}
    assert sum(b.nbytes for b in sent) < 2 * sum(map(len, texts))  # of random words; 3.0 when every depth had its list


def test_a_unit_sends_its_words_once_however_many_texts_hold_them():
    rng = random.Random(9)
    texts = [" ".join(rng.choices(["ab", "cd", "ef", "gh", "ij", "klm"], k=50)) for _ in range(20)]

    def sent(n):
        batch = pa.RecordBatch.from_pydict({"text": texts * n, "train": [True, False] * (len(texts) * n // 2)})
        return list(suffixtree._learned(64)(iter([batch])))

    assert sum(b.nbytes for b in sent(20)) < 2 * sum(b.nbytes for b in sent(1))


def test_counts_of_other_texts_are_refused():
    laid = [(np.frombuffer(b"ab cd", np.uint8), np.array([0, 5]))]
    with pytest.raises(RuntimeError):
        suffixtree._bases(laid, {}, 64)


def test_training_nothing_gives_equal_chances(spark):
    out = suffixtree.score(spark.createDataFrame([(None, "ab")], "doc_id long, text string")).first()
    assert out["held_out"] and out["score"] == pytest.approx(3 * math.log10(1 / 256))


def test_a_depth_of_a_units_runs_is_made_at_a_time():
    whole = np.unique(np.random.default_rng(2).integers(0, 1 << 56, 400_000))
    levels = suffixtree.Levels(whole, 6, 64)
    tracemalloc.start()
    for k in range(7):
        levels.at(k)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 10 * whole.nbytes


def test_tables_of_the_tree_do_not_stay_beside_the_answers(spark):
    folder = ensure_checkpoint_dir(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    out = suffixtree.score(spark.createDataFrame([(i, "the cat sat " * 9) for i in range(40)], "doc_id long, text string"))
    assert len(set(os.listdir(folder)) - before) == 2  # the answers for runs and for words
    assert out.count() == 40
