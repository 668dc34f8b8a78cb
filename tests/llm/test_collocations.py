"""Phrases against dictionaries of all n-grams."""

import collections
import random
import re

import pytest

from quantis.llm import collocations
from quantis.llm.oracles import ORACLE_SQL
from tests.llm.conftest import LOWER
from tests.llm.test_operators_on_odd_rows import collected, same

PIECE, WORD = re.compile("[.,;:!?\x0a-\x0d]"), re.compile("[^\x20\x09]+")


def brute(rows, longest=5, least=100, percent=100, top=2000):
    """Rows (lang, text) to the operator's result."""
    n, f = collections.Counter(), collections.Counter()
    for lang, text in rows:
        for piece in PIECE.split((text or "").translate(LOWER)):
            w = WORD.findall(piece)
            n[lang or "und" if lang is None else lang] += len(w)
            for k in range(1, longest + 1):
                for i in range(len(w) - k + 1):
                    f[("und" if lang is None else lang, tuple(w[i : i + k]))] += 1
    found = {x: c for x, c in f.items() if c >= least}
    covered = set()
    for (lang, w), c in found.items():
        for i in range(len(w)):
            for j in range(i + 2, len(w) + 1):
                if j - i < len(w) and 100 * c >= percent * found[(lang, w[i:j])]:
                    covered.add((lang, w[i:j]))
    out = collections.defaultdict(list)
    for (lang, w), a in found.items():
        if len(w) > 1 and (lang, w) not in covered:
            cuts = [(1000 * a * n[lang] // (found[(lang, w[:k])] * found[(lang, w[k:])]), k) for k in range(1, len(w))]
            score, k = min(cuts)
            out[lang].append((-score, -a, " ".join(w).encode(), found[(lang, w[:k])], found[(lang, w[k:])]))
    return [
        (lang, i, p.decode(), -a, left, right, n[lang], -score)
        for lang, rows_ in out.items() for i, (score, a, p, left, right) in enumerate(sorted(rows_)[:top], 1)
    ]


def table(spark, rows, parts=3):
    return spark.createDataFrame(rows, "lang string, text string").repartition(parts)


def some_rows(seed=1, n=200):
    rng = random.Random(seed)
    words = ["a", "b", "A", "to", "be", "or", "not", "é", "日本", "\x01x", "x\x01", "a\x0e", "und", "\x1c", "a-b", "ß"]
    gaps = [" "] * 8 + ["  ", "\t", ", ", ". ", "\n", "!?", " ;"]
    return [
        (rng.choice(["en", "en", "en", None, "und", "x y", ""]), "".join(rng.choice(words) + rng.choice(gaps) for _ in range(rng.randrange(0, 60))))
        for _ in range(n)
    ] + [("en", "to be or not to be " * 30), ("en", None), (None, ""), ("de", " \t. "), ("fr", "seul"), ("en", "again " * 300)]


@pytest.mark.parametrize("longest, least, percent, top", [(5, 5, 100, 2000), (3, 2, 60, 7), (2, 3, 100, 2000)])
def test_phrases_equal_brute_force(spark, longest, least, percent, top):
    rows = some_rows()
    same(collected(collocations.phrases(table(spark, rows), longest, least, percent, top)), brute(rows, longest, least, percent, top))


def test_partitions_that_begin_inside_a_words_phrases(spark):
    """Nearly all phrases begin and end with one word, over many partitions."""
    rng = random.Random(3)
    rows = [("en", " ".join(f"hot {rng.choice('abcdefgh')}{rng.choice('abc')}" for _ in range(50))) for _ in range(100)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "37")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        counted = collocations.frequent_phrases(table(spark, rows), 5, 3, "text", "lang")
        stream, above = collocations.laid_out(counted)
        assert any(k for _, k in above if k == ("hot",))
        assert stream.rdd.getNumPartitions() == 37
        got = collected(collocations.phrases(table(spark, rows), 5, 3))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    same(got, brute(rows, 5, 3))


def test_odd_and_clashing_rows(request, odd_rows):
    expected = brute([(r[2], r[1]) for r in odd_rows], 5, 2)
    for name in ("odd", "clashing"):
        same(collected(collocations.phrases(request.getfixturevalue(name), 5, 2)), expected)


def test_empty_tables(spark, empty):
    assert collected(collocations.phrases(empty)) == []
    assert collected(collocations.phrases(table(spark, [("en", None), (None, " ")]))) == []


def test_scores_beyond_64_bits_are_exact():
    a, n = 3_000_000_000, 9_000_000_000_000
    score, left, right = collocations.best_cut(a, n, [a, 2 * a], [a + 1, a])
    assert (score, left, right) == (1000 * a * n // (2 * a * a), 2 * a, a)
    # floored scores tie: the first cut counts
    assert collocations.best_cut(1, 1, [1001, 2000], [1, 1])[1:] == (1001, 1)


def test_units_of_many_sizes_agree(spark, monkeypatch):
    rows = some_rows(7, 80)
    monkeypatch.setattr(collocations, "UNIT_BYTES", 500)
    same(collected(collocations.phrases(table(spark, rows, 2), 4, 3)), brute(rows, 4, 3))


def test_parts_of_a_language_are_ranked_apart(spark):
    """One language holds everything: its last task ranks what its parts let through."""
    out = collocations.phrases(table(spark, [("en", t) for _, t in some_rows(9, 30)]), 3, 2, 100, 3)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Window [") == 2 and "hashpartitioning(lang#" in plan and "salt#" in plan
    assert sorted(r["rank"] for r in out.collect()) == [1, 2, 3]


def test_oracle_sql_on_small_counts(spark):
    """The registered SQL, its limit of 100 lowered, on the same rows."""
    import duckdb

    rows = some_rows(11, 60)
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (lang VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    sql = ORACLE_SQL["op13_collocations"].replace("count(*) >= 100", "count(*) >= 3")
    same(con.execute(sql).fetchall(), brute(rows, 5, 3))
