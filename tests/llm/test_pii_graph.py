"""Discovered spans against a graph of dictionaries, scored to its fixed point."""

import collections
import time

import pytest
import regex
from pyspark.sql import functions as F

from quantis.llm import pii
from tests.conftest import SF_SMALL
from tests.llm.test_operators_on_odd_rows import PII, collected, valid

SPACE = " \t\n\x0b\x0c\r"


def first_word(text):
    return regex.match(r"[\x20\x09-\x0D]*([^\x20\x09-\x0D]*)", text)[1]


def word(text):
    return regex.sub(r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$", "", text).lower()


def brute_matches(pattern, text):
    """(start, stop, match, word before, word after) of each match."""
    found = list(regex.finditer(pattern, text))
    out = []
    for i, m in enumerate(found):
        last, following = (found[i - 1] if i else None), (found[i + 1] if i + 1 < len(found) else None)
        before = (last[0] if last else "") + text[last.end() if last else 0 : m.start()]
        after = text[m.end() : following.start() if following else len(text)] + (following[0] if following else "")
        out.append((m.start(), m.end(), m[0], word(first_word(before[::-1])[::-1]), word(first_word(after))))
    return out


def patterns(match, left, right):
    shape = regex.sub("[A-Za-z]", "a", regex.sub("[0-9]", "9", match))
    return {p for p in (f"before {left}", f"after {right}", f"shape {shape}") if p not in ("before ", "after ")}


def brute_discovered(texts, support=3, limit=0.8, prior=1.0, rounds=200):
    """(text, kind, start, stop) that the method adds."""
    seeds, others = [], []
    for t in {t for t in texts if t and regex.search(pii.NEEDED, t)}:
        base = [(k, *m) for k in pii.KINDS for m in brute_matches(pii.PATTERNS[k], t) if valid(k, m[2])]
        seeds += [(t, *x) for x in base]
        others += [(t, *m) for m in brute_matches(pii.CANDIDATE, t) if not any(m[0] < b[2] and m[1] > b[1] for b in base)]
    links = collections.defaultdict(set)
    for _, _, _, _, match, left, right in seeds:
        for p in patterns(match, left, right):
            links[p].add(match.lower())
    for _, _, _, match, left, right in others:
        for p in patterns(match, left, right):
            links[p].add(match.lower())
    fixed = {(m.lower(), k): 1.0 for _, k, _, _, m, _, _ in seeds}
    known = {i for i, _ in fixed}
    loose = collections.defaultdict(set)
    for _, _, _, match, left, right in others:
        if match.lower() not in known:
            loose[match.lower()] |= patterns(match, left, right)
    scores = dict(fixed)
    for _ in range(rounds):
        confidence = {}
        for p, instances in links.items():
            for k in pii.KINDS:
                mine = [scores[(i, k)] for i in instances if (i, k) in scores]
                if sum(x >= limit for x in mine) >= support:
                    confidence[(p, k)] = sum(mine) / (len(instances) + prior)
        scores = dict(fixed)
        for i, ps in loose.items():
            for k in pii.KINDS:
                miss = 1.0
                for p in ps:
                    miss *= 1 - min(confidence.get((p, k), 0.0), 0.999999)
                if any((p, k) in confidence for p in ps):
                    scores[(i, k)] = 1 - miss
    best = {}
    for (i, k), x in scores.items():
        if x >= limit:
            best[i] = max(best.get(i, (0, "")), (x, k))
    return {
        (t, best[m.lower()][1], a, b) for t, a, b, m, _, _ in others if m.lower() in best and valid(best[m.lower()][1], m)
    }


def discovered(spark, texts):
    rows = [(i, t) for i, t in enumerate(texts)]
    out = set()
    for i, base, everything in pii.extract(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", "base_spans", "spans").collect():
        for s in set(everything.split(",")) - set(base.split(",")):
            if s:
                k, a, b = s.split(":")
                out.add((texts[i], k, int(a), int(b)))
    return out


def chain():
    """Numbers that only reach each other one after the other: what follows or
    precedes those of a step is shared with the next step's."""
    rows = [f"s{i} +1 (2{i % 90 + 10}) 55{i // 90 + 10}-32{i % 90 + 10} pa" for i in range(2500)]
    rows += [f"pb 0171 {i + 1000} 99 pa" for i in range(400)]
    rows += [f"pb 0{i + 100} 77777 pc" for i in range(70)]
    rows += [f"pd 03 {i + 100} 555 66 pc" for i in range(13)]
    return rows + ["pd 0888 12 345 pe"]


def test_the_method_equals_the_graph(spark):
    texts = [t for _, t in PII] + ["code AB12345 thanks", "x 0171 555 12 thanks my tel: 0172 555 13 thanks (0173)5551-4, thanks"]
    texts += [f"host 10.0.{i}.7 up" for i in range(5)] + ["host 10.0.0.7.1 up", "host 999.0.0.1 up", "write jo[at]x.org or me @ 12", "é 😀 my tel: 0999 111 22, thanks"]
    got = discovered(spark, texts)
    assert got == brute_discovered(texts) and len(got) > 3


def test_rounds_go_on_to_the_fixed_point(spark, monkeypatch):
    texts = chain()
    got = discovered(spark, texts)
    assert got == brute_discovered(texts)
    assert sum("pe" in t for t, *_ in got) == 1 and len(got) == 484
    assert sum("pe" in t for t, *_ in brute_discovered(texts, rounds=3)) == 0  # what three rounds would miss
    before = pii.discover.__defaults__
    monkeypatch.setattr(pii.discover, "__defaults__", (2, *before[1:]))
    with pytest.warns(UserWarning, match="still rise"):
        assert discovered(spark, texts) < got


def test_small_documents(spark):
    texts = [r["text"] for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("text").collect()]
    assert discovered(spark, texts) == brute_discovered(texts)


def test_a_text_with_very_many_matches_takes_linear_time(spark):
    def seconds(n):
        df = spark.createDataFrame([(1, "mail a@b.cc or 0171 555 12 x, " * n)], "doc_id long, text string")
        t = time.perf_counter()
        out = collected(pii.extract(df))
        return time.perf_counter() - t, out[0][1]

    seconds(100)
    (few, n_few), (many, n_many) = seconds(4_000), seconds(32_000)
    assert n_few == 4_000 and n_many == 32_000 and many < 4 * few + 3


def test_null_ids_and_clashing_columns(spark, clashing):
    rows = [(None, "my tel: +1 (269) 555-3296 thanks")] * 2 + [(i, f"my tel: +1 (2{i:02d}) 555-3296 thanks") for i in range(9)] + [(None, "my tel: 0171 555 12 thanks")]
    out = pii.extract(spark.createDataFrame(rows, "doc_id long, text string"))
    assert out.filter("doc_id is null and spans = 'phone:8:25'").count() == 2
    assert out.filter("doc_id is null and spans = 'phone:8:19'").count() == 1
    a, b = pii.extract(clashing), pii.extract(clashing.select("doc_id", F.col("text")))
    assert collections.Counter(map(tuple, a.collect())) == collections.Counter(map(tuple, b.collect()))
