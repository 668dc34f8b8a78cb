"""Results that must not depend on rounding or on hashes."""

import collections
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from quantis.llm import bpe, mtree, neardup, rules, wordbatch
from tests.llm.test_operators_on_odd_rows import brute_top, collected, same

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def regular_pair(n=10):
    """Two different strings that polynomial hashes modulo 2**64 confuse."""
    x, y = "a", "b"
    for _ in range(n):
        x, y = x + y, y + x
    return x, y


def test_regular_words_get_their_own_ids(spark):
    x, y = regular_pair()
    rows = [(1, x), (2, y), (3, f"{x} {y} {x}")]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    t = Tokenizer.from_file(WORD_BPE)
    got = dict(collected(bpe.encode(df, WORD_BPE)))
    assert {i: ids for i, ids in got.items()} == {i: t.encode(s, add_special_tokens=False).ids for i, s in rows}


def test_regular_lines_and_sets_are_distinct(spark):
    x, y = regular_pair()
    df = spark.createDataFrame([(1, f"{x}\n{y}"), (2, f"{x}\n{x}\n{y}"), (3, x), (4, y)], "doc_id long, text string").selectExpr("*", "'en' AS lang")
    found = {r["doc_id"]: r["n_dup_lines"] for r in rules.judge(df).collect()}
    assert found == {1: 0, 2: 1, 3: 0, 4: 0}
    nodes = {r["doc_id"]: r["node"] for r in neardup.classes(df).collect()}
    assert len(set(map(bytes, nodes.values()))) == 4


def test_lines_that_share_a_hash_are_told_apart_by_their_bytes(monkeypatch):
    monkeypatch.setattr(rules, "bytes_hash", lambda data, start, end: np.full(len(start), 7, np.uint64))
    texts = ["a b\nc d\na b\n\n \nc d\na b", "x\ny", "", "z\nz\nq"]
    got = np.concatenate([rules.duplicate_lines(w) for w in wordbatch.split_words(pa.array(texts))])
    assert got.tolist() == [3, 0, 0, 1]


def test_no_two_strings_of_a_kind_share_a_hash():
    rng = random.Random(1)
    words = {"".join(rng.choices("ab", k=rng.randrange(1, 60))) for _ in range(20_000)} | {"a" * n for n in range(1, 3000)}
    words |= {s for n in range(1, 12) for s in regular_pair(n)} | {"\x00" * n for n in range(1, 40)}
    words = sorted(words)
    h = np.concatenate([wordbatch.word_hash(w) for w in wordbatch.split_words(pa.array([" ".join(words)]), limit=1 << 40)])
    assert len(h) == len(words) == len(set(h.tolist()))
    runs = [wordbatch.run_hash(h, n) for n in (2, 3, 5, 20, 35)]
    assert all(len(set(r.tolist())) == len(r) for r in runs)
    again = wordbatch.run_hash(np.concatenate([h[100:200], h[5:9], h[100:200]]), 35)
    assert (again[:66] == again[104:]).all()


def test_the_session_is_left_as_it_was(spark):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    df = spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string")
    neardup.classes(df).collect()
    assert spark.conf.get(key) == before


@pytest.mark.parametrize("size", [1, 2**11, 2**18, 2**20])
def test_scores_are_exact_at_any_size(spark, monkeypatch, size):
    rng = np.random.default_rng(size % 97)
    base = rng.normal(size=(400, 8)) * size
    base[200:300] = base[100] + rng.normal(size=(100, 8)) * size * 1e-9  # hard to tell apart
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(base)]
    for name, value in (("TREE_ROWS", 150), ("PAGE", 16), ("BLOCK", 5)):
        monkeypatch.setattr(mtree, name, value)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = collected(mtree.top_k(df, df.filter("vec_id % 50 = 0")))
    expected = brute_top(rows, 5)
    assert all(abs(r[3]) < 1 << 63 for r in expected)
    same(got, expected)


def test_what_leaves_the_long_range_raises(spark):
    df = spark.createDataFrame([(0, [1e30]), (1, [1.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="range of a long"):
        mtree.top_k(df, df).collect()
    df = spark.createDataFrame([(0, [2.0**50] * 4), (1, [2.0**50] * 4)], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="range of a long"):
        mtree.top_k(df, df).collect()


def test_top_k_with_clashing_columns(spark):
    names = ("id", "vector", "query", "rank", "score", "tree", "dim", "page", "ids")
    rows = [(i, [float(i % 7), 1.0], *names) for i in range(60)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>" + "".join(f", {n} string" for n in names))
    same(collected(mtree.top_k(df, df.filter("vec_id % 50 = 0"), k=3)), brute_top([(r[0], r[1]) for r in rows], 3))


def test_ties_among_common_words_go_to_the_smaller_word(spark):
    many = 70  # words of equal frequency, more than a reference keeps
    words = [f"w{i:02d}" for i in range(many)]
    docs = spark.createDataFrame([(i, " ".join(words), "en") for i in range(40)], "doc_id long, text string, lang string")
    kept = rules.reference_table(docs, "text", "lang").filter("word is not null")
    assert sorted(r["word"] for r in kept.collect()) == words[: rules.COMMON]


def test_one_row_of_each_class_with_clashing_columns(clashing, odd_rows):
    kept = neardup.one_of_each(clashing)
    assert kept.columns == clashing.columns
    ids = collections.Counter(r["doc_id"] for r in kept.collect())
    plain = collections.Counter(r["doc_id"] for r in neardup.one_of_each(clashing.select("doc_id", "text")).collect())
    assert ids == plain


def test_equal_rows_take_linear_time(spark):
    """Copies of one row tell their repeats once a batch and set them once a row."""
    import time

    from quantis.llm import substring

    text = " ".join(f"word{i}" for i in range(60))

    def seconds(n):
        df = spark.range(n, numPartitions=4).selectExpr("7L AS doc_id", f"'{text}' AS text").union(spark.createDataFrame([(8, "a b c")]))
        t = time.perf_counter()
        out = substring.remove_repeats(df).groupBy("n_words", "n_removed", "kept").count().collect()
        assert sorted(map(tuple, out)) == [(3, 0, "a b c", 1), (60, 60, "", n)]
        return time.perf_counter() - t

    seconds(100)
    few, many = seconds(32_000), seconds(64_000)
    assert many < 2 * few + 2


def test_units_do_not_depend_on_batches(monkeypatch):
    """Two reads of one table may bring it in batches of other sizes."""
    from quantis.llm import units

    rng = random.Random(2)
    rows = pa.table({"id": list(range(400)), "text": [" ".join(rng.choices("abcdef", k=rng.randrange(0, 90))) or None for _ in range(400)]})
    monkeypatch.setattr(units, "UNIT_BYTES", 900)

    def found(size):
        out = []
        for name, held in units.named(iter(rows.to_batches(max_chunksize=size))):
            ids = [i for part, w in held for i in part.column("id").slice(w.row, w.n_docs).to_pylist()]
            out.append((name + units.digest(held), ids))
        return out

    assert found(1) == found(7) == found(400) and len(found(7)) > 10
    assert [i for _, ids in found(7) for i in ids] == list(range(400))
