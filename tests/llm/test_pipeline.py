"""The corpus pipeline, stage by stage, and the registered queries."""

import collections

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from quantis.llm import mixing, neardup, pii, quality
from quantis.llm.queries import ORACLE_SQL, QUERIES
from tests.conftest import SF_SMALL
from tests.oracle_check import duck, rows_of


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Input and result of every stage, each written and read again."""
    out, docs = {}, spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / name)
        stage(spark, docs, SF_SMALL).write.parquet(path)
        out[name] = (docs, spark.read.parquet(path))
        docs = out[name][1]
    return out


def test_stages_keep_the_columns(stages):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_classifier", "minhash_near_dedup", "pii", "mixing_sources", "bpe"]
    for n in names[:-1]:
        before, after = stages[n]
        assert after.columns == before.columns


def test_quality_stage(spark, stages):
    docs, kept = stages["quality_classifier"]
    model = quality.learn(docs, spark.read.parquet(f"{SF_SMALL}/labels.parquet"))
    expect = {r[0] for r in quality.scored(docs, model, keep=["doc_id"]).filter("score >= 0.5").select("row.doc_id").collect()}
    assert {r[0] for r in kept.select("doc_id").collect()} == expect
    assert kept.exceptAll(docs).isEmpty()


def test_near_dedup_stage(stages):
    docs, kept = stages["minhash_near_dedup"]
    found = neardup.classes(docs)
    expect = found.filter("doc_id = component_id").select("doc_id").distinct()
    assert sorted(kept.select("doc_id").collect()) == sorted(expect.collect())
    assert kept.exceptAll(docs).isEmpty()


def test_pii_stage(stages):
    docs, clean = stages["pii"]
    spans = {r["doc_id"]: r["spans"] for r in pii.extract(docs).collect()}
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in clean.collect():
        if not spans[r["doc_id"]]:
            assert r["text"] == text[r["doc_id"]]
        for s in filter(None, spans[r["doc_id"]].split(",")):
            _, a, b = s.split(":")
            assert text[r["doc_id"]][int(a) : int(b)] not in r["text"]
        assert r["n_chars"] == len(r["text"])


def test_mixing_stage(stages):
    docs, mixed = stages["mixing_sources"]
    expect = {r["doc_id"]: r["copies"] for r in mixing.report(docs).collect() if r["copies"]}
    assert collections.Counter(r[0] for r in mixed.select("doc_id").collect()) == expect


def test_bpe_stage(stages):
    docs, out = stages["bpe"]
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    texts = collections.Counter((r["doc_id"], tuple(library.encode(r["text"], add_special_tokens=False).ids)) for r in docs.collect())
    assert collections.Counter((r["doc_id"], tuple(r["ids"])) for r in out.collect()) == texts
    r = out.first()
    assert r["decoded"] == library.decode(list(r["ids"]), skip_special_tokens=False) and r["n_tokens"] == len(r["ids"])


def test_run_is_the_stages_one_after_the_other(spark, stages):
    got = corpus_pipeline.run(spark, SF_SMALL)
    expect = stages["bpe"][1]
    assert got.columns == expect.columns
    assert got.exceptAll(expect).isEmpty() and expect.exceptAll(got).isEmpty()


def test_stages_take_empty_tables_and_further_columns(spark, clashing, empty):
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF_SMALL).count() == 0, name
        out = stage(spark, clashing, SF_SMALL)
        if name != "bpe":
            assert out.columns == clashing.columns, name
        assert out.count() >= 0


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_oracle(spark, name):
    out = QUERIES[name](spark, SF_SMALL)
    res = duck(SF_SMALL).execute(ORACLE_SQL[name])
    names = [d[0] for d in res.description]
    assert sorted(out.columns) == sorted(names)
    assert rows_of(out.columns, [tuple(r) for r in out.collect()], None) == rows_of(names, res.fetchall(), None)


def test_native_operator_runs_no_python(spark):
    """Operator 7 is built from DataFrame functions only."""
    plan = QUERIES["op7_pii_bootstrap"](spark, SF_SMALL)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
    source = open(pii.__file__, encoding="utf-8").read()
    assert not any(x in source for x in ("mapInArrow", "applyIn", "udf", ".rdd", "pandas", "pyarrow"))


def test_every_query_is_registered():
    import __spark_entry__ as entry

    names = entry.queries()
    assert {n.split("_")[0] for n in names if n.startswith("op")} >= {f"op{i}" for i in range(1, 11)} and "pipeline" in names
