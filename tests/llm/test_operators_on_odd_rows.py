"""Every operator against brute force on nulls, empty and very long texts,
ties, repeated rows, empty tables and clashing column names."""

import collections
import math
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quantis.llm import bpe, mixing, mtree, neardup, pii, quality, rules, substring, suffixtree, tokencount
from tests.llm.conftest import LOWER, words

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def collected(df):
    return [tuple(r) for r in df.collect()]


def same(got, expected):
    assert collections.Counter(got) == collections.Counter(expected)


# 1 substring dedup


def brute_repeats(rows, window):
    docs = [(r[0], words(r[1])) for r in rows]
    seen = collections.Counter(tuple(w[i : i + window]) for _, w in docs for i in range(len(w) - window + 1))
    out = []
    for i, w in docs:
        gone = {p for s in range(len(w) - window + 1) if seen[tuple(w[s : s + window])] > 1 for p in range(s, s + window)}
        out.append((i, len(w), len(gone), " ".join(x for p, x in enumerate(w) if p not in gone)))
    return out


@pytest.mark.parametrize("table", ["odd", "clashing"])
def test_substring(request, odd_rows, table):
    got = collected(substring.remove_repeats(request.getfixturevalue(table), window=10, anchor=6))
    same(got, brute_repeats(odd_rows, 10))


def test_substring_empty(empty):
    assert collected(substring.remove_repeats(empty)) == []


def test_sketch_never_underestimates():
    rng = np.random.default_rng(3)
    h = rng.integers(1, 1 << 63, 400, dtype=np.uint64)
    h[300:350] = h[100:150]  # a passage that repeats
    first = np.array([0, 250, 400])
    least, ok, places = substring.window_anchors(h, first, 35, 20)
    counts = collections.Counter(places.tolist())
    runs = substring.run_hash(h, 35)
    windows = collections.Counter(runs[ok].tolist())
    for s in np.flatnonzero(ok):
        assert counts[int(least[s])] >= windows[int(runs[s])]


# 2 near-duplicates


def shingles(text, n):
    w = words((text or "").translate(LOWER))
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def brute_classes(rows, n, percent=80):
    sets = [shingles(r[1], n) for r in rows]
    label = list(range(len(rows)))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                label[root(a)] = root(b)
    names = collections.defaultdict(list)
    for x, r in enumerate(rows):
        if r[0] is not None:
            names[root(x)].append(r[0])
    return [(r[0], len(sets[x]), min(names[root(x)], default=None)) for x, r in enumerate(rows)]


@pytest.mark.parametrize("table", ["odd", "clashing"])
def test_near_duplicates(request, odd_rows, table):
    out = neardup.classes(request.getfixturevalue(table), shingle=4).select("doc_id", "n_shingles", "component_id")
    same(collected(out), brute_classes(odd_rows, 4))


def test_near_duplicates_of_a_hot_group(spark):
    """Copies of one text with more and more edits: links between different
    texts are found although no pairs are listed."""
    rng = np.random.default_rng(5)
    base = [f"b{i}" for i in range(120)]
    rows = []
    for i in range(150):
        w = list(base)
        for at in rng.choice(120, rng.integers(0, 14), replace=False):
            w[at] = f"e{i}x{at}"
        rows.append((i, " ".join(w)))
    rows += [(1000 + i, " ".join(f"q{i}z{j}" for j in range(50))) for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = neardup.classes(df, shingle=4).select("doc_id", "n_shingles", "component_id")
    same(collected(got), brute_classes(rows, 4))


def test_blocks_of_a_large_cluster_give_the_same_classes(spark, monkeypatch):
    rng = np.random.default_rng(6)
    base = [f"b{i}" for i in range(80)]
    rows = []
    for i in range(60):
        w = list(base)
        for at in rng.choice(80, rng.integers(0, 10), replace=False):
            w[at] = f"e{i}x{at}"
        rows.append((i, " ".join(w)))
    monkeypatch.setattr(neardup, "BLOCK", 7)
    monkeypatch.setattr(neardup, "MEMBERS", 5)
    got = neardup.classes(spark.createDataFrame(rows, "doc_id long, text string"), shingle=4)
    same(collected(got.select("doc_id", "n_shingles", "component_id")), brute_classes(rows, 4))


def test_one_of_each(odd, odd_rows, empty):
    kept = collected(neardup.one_of_each(odd, shingle=4))
    expect = brute_classes(odd_rows, 4)
    classes = {c for (_, n, c) in expect if n}
    assert len([r for r in kept if words(r[1])]) == len(classes)
    assert len([r for r in kept if not words(r[1])]) == len([r for r in odd_rows if not words(r[1])])
    assert set(kept) <= set(odd_rows)
    assert collected(neardup.one_of_each(empty)) == []
    assert collected(neardup.classes(empty)) == []


def test_pruning_keeps_pairs_at_the_limit():
    """A pair of similarity 0.8 is hardly ever dropped, one of 0.3 always."""
    least = neardup.least_matches(80)
    rng = np.random.default_rng(1)
    for similarity, dropped in ((0.8, 0), (0.3, 2000)):
        found = rng.random((2000, neardup.HASHES)) < similarity
        cum = np.cumsum(found, axis=1)[:, neardup.BATCH - 1 :: neardup.BATCH]
        assert (cum < np.array(least)).any(axis=1).sum() == dropped


# 3 language model


def test_language_model_empty(empty):
    assert collected(suffixtree.score(empty)) == []


def test_language_model_beats_the_base_on_held_out_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    held = suffixtree.score(docs).filter("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert held[0] > held[1]


# 4 mixing


def brute_targets(rows, weights=(1, 2, 3), most=3):
    size = collections.Counter()
    for r in rows:
        size[r[3]] += len(words(r[1]))
    names = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, free, left = {}, set(names), float(sum(size.values()))
    while free:
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] >= most * size[s]]
        if not over:
            target |= share
            break
        for s in over:
            target[s] = most * size[s]
            left -= target[s]
            free.discard(s)
    return size, target


def test_mixing(odd, odd_rows, empty, clashing):
    size, target = brute_targets(odd_rows)
    got = [r.asDict() for r in mixing.report(odd).collect()]
    assert len(got) == len(odd_rows)
    by_row = collections.Counter((r[0], len(words(r[1])), size[r[3]], round(target[r[3]], 6)) for r in odd_rows)
    assert collections.Counter((r["doc_id"], r["size"], r["source_size"], round(r["target"], 6)) for r in got) == by_row
    assert all(r["taken"] <= 3 * r["size"] and r["taken"] == r["size"] * r["copies"] for r in got)
    assert collections.Counter(map(str, got)) == collections.Counter(str(r.asDict()) for r in mixing.report(odd).collect())
    mixed = mixing.mix(clashing)
    assert mixed.columns == clashing.columns and mixed.count() == sum(r["copies"] for r in got)
    assert mixing.mix(empty).count() == 0 and mixing.report(empty).count() == 0


def test_mixing_reaches_targets_and_salted_join_agrees(spark, monkeypatch):
    df = spark.range(6000).selectExpr(
        "id AS doc_id", "repeat('w ', cast(1 + id % 7 AS int)) AS text", "if(id % 3 = 0, 'hot', concat('s', id % 20)) AS source"
    )
    plain = sorted(map(str, mixing.report(df).collect()))
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 0)
    assert sorted(map(str, mixing.report(df).collect())) == plain
    by_source = mixing.report(df).join(df, "doc_id").groupBy("source", "target").agg(F.sum("taken").alias("taken")).collect()
    assert len(by_source) > 10
    for r in by_source:
        assert r["taken"] == pytest.approx(r["target"], rel=0.25)


# 5 quality


def test_quality_on_odd_rows(spark, odd, odd_rows, empty, clashing):
    labels = spark.createDataFrame([(1, 1, 0), (2, 1, 0), (10, 0, 0), (None, 1, 0), (6, 1, 0), (6, 0, 0), (9, None, 0)], "doc_id long, quality int, toxic int")
    model = quality.learn(odd, labels)
    got = quality.scored(odd, model, keep=["doc_id"]).collect()
    assert len(got) == len(odd_rows) and all(0 <= r["score"] <= 1 for r in got)
    kept = quality.keep_good(clashing, labels)
    assert kept.columns == clashing.columns
    assert quality.keep_good(empty, labels).count() == 0
    nothing = quality.learn(odd, labels.limit(0))
    assert {r["score"] for r in quality.scored(odd, nothing).collect()} == {0.5}


def test_prior_and_held_out_accuracy(spark):
    """On the given labels: the prior is near the share of good texts, and
    held-out labels are met."""
    base = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{base}/documents.parquet"), spark.read.parquet(f"{base}/labels.parquet")
    model = quality.learn(docs, labels)
    share = labels.agg(F.avg("quality")).first()[0]
    assert model.prior == pytest.approx(share, abs=0.08)
    scored = quality.scored(docs, model, keep=["doc_id"]).select("row.doc_id", "score").filter(quality.held_out(F.col("doc_id")))
    right = scored.join(labels, "doc_id").select(((F.col("score") >= 0.5).cast("int") == F.col("quality")).cast("int").alias("ok"))
    assert right.agg(F.avg("ok")).first()[0] > 0.97


def test_labels_of_held_out_rows_and_zeros_do_not_matter(spark):
    base = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{base}/documents.parquet"), spark.read.parquet(f"{base}/labels.parquet")
    first = quality.learn(docs, labels)
    flipped = labels.withColumn("quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert np.array_equal(first.weights, quality.learn(docs, flipped).weights)


# 6 top-k


def brute_top(rows, k):
    good = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v):
            good[(i, tuple(math.floor(256 * x) for x in v))] = None
    out = []
    for q, qv in good:
        if q % 50 == 0:
            scored = sorted((-sum(a * b for a, b in zip(qv, v)), i) for i, v in good if i != q and len(v) == len(qv))
            out += [(q, r, i, -s) for r, (s, i) in enumerate(scored[:k], 1)]
    return out


def test_top_k(spark, monkeypatch):
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.normal(size=6).round(2)]) for i in range(1500)]
    rows += [(2000 + i, [0.5, 0.25, 0.0, 0.0, 0.0, 1.0]) for i in range(200)]  # one common vector
    rows += [(None, [1.0] * 6), (3001, None), (3002, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (3003, [float("nan")] * 6), (3004, [float("inf")] * 6)]
    rows += [(3050, [1.0, 2.0]), (3051, [1.0, 1.0]), (3052, []), rows[0], (3100, [3.0, 1.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    exact = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    monkeypatch.setattr(mtree, "TREE_ROWS", 400)
    monkeypatch.setattr(mtree, "BLOCK", 10)
    monkeypatch.setattr(mtree, "PAGE", 16)
    same(collected(mtree.top_k(df, df.filter("vec_id % 50 = 0"))), brute_top(exact, 5))
    assert collected(mtree.top_k(df.limit(0), df.limit(0))) == []


# 7 personal data

BASE = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
)


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def valid(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(x) <= 255 for x in match.split("."))
    if kind == "card":
        return 16 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 8 <= len(digits) <= 15


def brute_spans(text):
    return [f"{k}:{m.start()}:{m.end()}" for k, p in BASE for m in re.finditer(p, text or "") if valid(k, m[0])]


PII = [
    (1, "mail a.b@c.d_e@f.gg and x@@y.z q@w 1.2.3.4.5.6.7.8 300.1.1.1 010.020.03.255"), (2, None), (3, ""),
    (4, "é😀 +1 (269) 555-3296 4524132264652876 and 4539 1488 0343 6467 x"), (5, "1 2 3 4 5 6 7 8 9 0 " * 2000),
    (6, "1" * 50000 + " a@b.c " + "x" * 30000), (1, "mail a.b@c.d_e@f.gg"), (None, "a@b.cc"), (9, "a@b.cc " * 3000), (9, "a@b.cc " * 3000),
] + [(100 + i, f"my tel: +1 (2{i:02d}) 555-329{i % 10} thanks") for i in range(20)] + [
    (200, "my tel: 0171 555 12 thanks"), (201, "a number 0999 888 77 here"), (202, "my tel: 12 thanks"),
]


def test_base_spans_and_discovery(spark, empty, clashing):
    df = spark.createDataFrame(PII, "doc_id long, text string")
    got = collected(pii.extract(df))
    expect = [(i, *(sum(s.startswith(k + ":") for s in brute_spans(t)) for k, _ in BASE), ",".join(brute_spans(t))) for i, t in PII]
    same([r[:6] for r in got], expect)
    spans = {r[0]: r[6] for r in got}
    assert spans[200] == "phone:8:19"  # between the words around the seeds
    assert spans[201] == "" and spans[202] == ""
    assert "phone:3:20" in spans[4]  # a number that ran into the next one
    for r in got:
        assert set(filter(None, r[5].split(","))) <= set(r[6].split(","))
    assert pii.extract(empty).count() == 0 and pii.redact(empty).count() == 0
    assert pii.redact(clashing).columns == clashing.columns
    assert pii.redact(clashing).count() == clashing.count()


def test_redaction(spark):
    df = spark.createDataFrame(PII, "doc_id long, text string")
    out = collections.defaultdict(list)
    for i, t in collected(pii.redact(df)):
        out[i].append(t)
    assert out[100] == ["my tel: [PHONE] thanks"]
    assert "mail [EMAIL][EMAIL] and x@@y.z q@w [IP].[IP] 300.1.1.1 [IP]" in out[1]
    assert out[2] == [None] and out[3] == [""] and out[201] == ["a number 0999 888 77 here"]


def test_known_identifier_that_runs_into_other_digits(spark):
    rows = [(1, "card 4845168114407329 ok"), (2, "pay 7536784127813051 4845168114407329 now"), (3, "id 7536784127813051 x")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r[0]: r[6] for r in collected(pii.extract(df))} == {1: "card:5:21", 2: "card:21:37", 3: ""}
    assert {i: t for i, t in collected(pii.redact(df))} == {1: "card [CARD] ok", 2: "pay 7536784127813051 [CARD] now", 3: rows[2][1]}


# 8 and 10 tokens


@pytest.mark.parametrize("table", ["odd", "clashing"])
def test_encoding_and_decoding(request, odd_rows, table):
    df = request.getfixturevalue(table)
    library = Tokenizer.from_file(WORD_BPE)
    got = collected(bpe.decode(bpe.encode(df, WORD_BPE, packed=True), WORD_BPE))
    expect = []
    for r in odd_rows:
        ids = library.encode(r[1] or "", add_special_tokens=False).ids
        expect.append((r[0], np.array(ids, "<u4").tobytes(), library.decode(ids, skip_special_tokens=False)))
    same([(i, bytes(b), t) for i, b, t in got], expect)


SPECIAL = ["<|endoftext|>a<|endoftext|>", "It's ΑΣ ΑΣ. İ ﬁ ½²Ⅷ", "é ́x Å", "a b\u0085c", "日本語12345 😀", "don't WE'LL", "a<|startoftext|> b"]


def test_special_texts_like_the_library(spark, empty):
    df = spark.createDataFrame(list(enumerate(SPECIAL)), "doc_id long, text string")
    library = Tokenizer.from_file(WORD_BPE)
    got = {i: list(ids) for i, ids in collected(bpe.encode(df, WORD_BPE))}
    assert got == {i: library.encode(t, add_special_tokens=False).ids for i, t in enumerate(SPECIAL)}
    assert collected(bpe.encode(empty, WORD_BPE)) == []
    with pytest.raises(ValueError):
        bpe.encode(df, BYTE_BPE)


@pytest.mark.parametrize("table", ["odd", "clashing"])
def test_token_counts(request, odd_rows, empty, table):
    library = Tokenizer.from_file(BYTE_BPE)
    got = collected(tokencount.count_tokens(request.getfixturevalue(table), BYTE_BPE))
    expect = []
    for r in odd_rows:
        n = len(library.encode(r[1] or "", add_special_tokens=False).ids)
        expect.append((r[0], len((r[1] or "").encode()), n, n > 1024))
    same(got, expect)
    assert collected(tokencount.count_tokens(empty, BYTE_BPE)) == []


def test_counts_of_special_texts_and_forgetting(monkeypatch):
    library = Tokenizer.from_file(BYTE_BPE)
    table = tokencount.Merges(BYTE_BPE)
    monkeypatch.setattr(tokencount, "REMEMBERED", 3)
    for t in [*SPECIAL, "  two  spaces \n\n x", "aaaa" * 500, "", " "]:
        assert table.count(t) == len(library.encode(t, add_special_tokens=False).ids), t


# 9 rules


def brute_rules(text):
    w = words(text)
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    c = collections.Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    covered = {p for i in range(len(w) - 7) if c[tuple(w[i : i + 8])] > 1 for p in range(i, i + 8)}
    failed = len(w) < 20 or 100 * len(covered) > 30 * len(w)
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(covered), failed)


@pytest.mark.parametrize("table", ["odd", "clashing"])
def test_rules(request, odd_rows, empty, table):
    out = rules.judge(request.getfixturevalue(table))
    got = collected(out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"))
    same(got, [(r[0], *brute_rules(r[1])) for r in odd_rows])
    assert out.filter("base_failed AND kept").count() == 0
    assert rules.judge(empty).count() == 0


def test_divergence_rejects_odd_distributions_only(spark):
    base = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{base}/documents.parquet"), spark.read.parquet(f"{base}/labels.parquet")
    both = rules.judge(docs).join(labels, "doc_id").filter("NOT base_failed AND n_words >= 50")
    rejected = {r["quality"]: r["share"] for r in both.groupBy("quality").agg(F.avg((~F.col("kept")).cast("int")).alias("share")).collect()}
    assert rejected[1] == 0 and rejected[0] > 0.7


@pytest.mark.parametrize("broadcast", [10_000, 0])
def test_rare_languages_are_judged_by_their_own_reference_or_not(spark, monkeypatch, broadcast):
    monkeypatch.setattr(rules, "BROADCAST", broadcast)
    monkeypatch.setattr(rules, "LEAST_SHARE", 0.2)
    rng = np.random.default_rng(3)

    def text(letters, n=60):
        return " ".join("".join(rng.choice(list(letters), 5)) for _ in range(n))

    rows = [(i, text("abcdefgh"), "la") for i in range(300)] + [(1000 + i, text("бвгдежзи"), "ru") for i in range(50)]
    rows += [(2000, text("αβγδεζηθ"), "el"), (2001, text("αβγδεζηθ"), None), (3000, text("#$%&|<>*"), "ru"), (3001, text("#$%&|<>*"), "la")]
    out = rules.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert sorted(r[0] for r in out.filter("NOT kept").select("doc_id").collect()) == [3000, 3001]


def test_divergence_by_hand():
    p = np.array([[0.5, 0.5, 0.0], [1.0, 0.0, 0.0]])
    q = np.array([0.0, 0.0, 1.0])
    assert np.allclose(rules.divergence(p, q), 1.0)
    assert np.allclose(rules.divergence(p, p[0]), [0, 0.31127812])


