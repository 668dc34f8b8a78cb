"""One query per operator, with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quantis.llm import alignment, bpe, collocations, htmltext, mixing, mtree, neardup, pii, quality, rules, substring, suffixtree, tokencount
from quantis.llm.oracles import ORACLE_SQL  # noqa: F401

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring.remove_repeats(table(spark, sf_dir, "documents"), window=35)
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept"), 256).alias("kept_sha256"))


def op2_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = neardup.classes(table(spark, sf_dir, "documents"), shingle=4, percent=80)
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False))
    return out.select("doc_id", "n_shingles", "component_id", kept.alias("kept"))


def op3_suffix_tree_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixtree.score(table(spark, sf_dir, "documents"), folds=10)


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.report(table(spark, sf_dir, "documents"))


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.learn(docs, table(spark, sf_dir, "labels"))
    return quality.scored(docs, model, keep=["doc_id"]).select(
        "row.doc_id", quality.held_out(F.col("row.doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op6_mtree_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return mtree.top_k(rows, rows.filter("vec_id % 50 = 0"), k=5, scale=256)


def op7_pii_bootstrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pii.extract(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2("base_spans", 256).alias("base_sha256"), "spans")


def op8_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    out = bpe.decode(bpe.encode(table(spark, sf_dir, "documents"), tokenizer, packed=True), tokenizer)
    return out.select(
        "doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.sha2(F.col("ids"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judge(table(spark, sf_dir, "documents"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), limit=1024)


def op11_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = htmltext.extract(table(spark, sf_dir, "pages"), keep=["page_id", "url"])
    return out.select("row.page_id", "row.url", "text", "n_chars")


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    out = alignment.report(table(spark, sf_dir, "documents"), a, b)
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "n_shared")


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.phrases(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_minhash_near_dedup": op2_minhash_near_dedup,
    "op3_suffix_tree_score": op3_suffix_tree_score,
    "op4_mix_sources": op4_mix_sources,
    "op5_quality_classifier": op5_quality_classifier,
    "op6_mtree_top_k": op6_mtree_top_k,
    "op7_pii_bootstrap": op7_pii_bootstrap,
    "op8_bpe_round_trip": op8_bpe_round_trip,
    "op9_quality_rules": op9_quality_rules,
    "op10_token_counts": op10_token_counts,
    "op11_html_text": op11_html_text,
    "op12_token_alignment": op12_token_alignment,
    "op13_collocations": op13_collocations,
}
