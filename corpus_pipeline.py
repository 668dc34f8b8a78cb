"""A training corpus from ``documents``, in stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
each result as Parquet in the shared checkpoint folder and rereads it as the
next stage's documents.  All stages but the last return the columns of
documents, and whatever further columns the documents have pass through them.

Defined cases, in every stage: null, empty and very long texts are rows like
any other.  The classifier scores null and empty texts as texts without words;
near-duplicates leave documents without words alone, and keep one row of each
class (of rows that share an id, the one with the least set); personal data is
looked for in texts that are there, a null text stays null; the mix takes no
copy of a document without words, null sources count as one, and equal rows
are drawn alike; null and empty texts are encoded to no tokens.  Null ids
stay.  A table without rows passes through all stages.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quantis.llm import bpe, mixing, neardup, pii, quality
from quantis.llm.work import bounded_batches, checkpoint_dir


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts (operator 5)."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (operator 2): word
    5-grams, similarity of 0.8 or more."""
    return neardup.one_of_each(docs, shingle=5, percent=80)


def without_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind (operator 7)."""
    clean = pii.redact(docs)
    return clean.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else clean


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them (operator 4)."""
    return mixing.mix(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, token ids, their number, and the text they decode to
    (operator 8)."""
    return bpe.encoded_rows(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality_classifier", good),
    ("minhash_near_dedup", distinct),
    ("pii", without_pii),
    ("mixing_sources", mixed),
    ("bpe", encoded),
]

#: The learned stages cannot be expressed in SQL: see tests/llm/test_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies every stage to the whole documents table."""
    folder = f"{checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    with bounded_batches(spark):
        for i, (name, stage) in enumerate(STAGES):
            out = f"{folder}/{i}-{name}"
            stage(spark, docs, sf_dir).write.parquet(out)
            docs = spark.read.parquet(out)
    return docs
