"""Memory and disk that operators hold at once."""

import contextlib
import io
import time
import tracemalloc

import numpy as np
from pyspark.sql import functions as F

from quantis.llm import neardup, pii, quality
from quantis.llm.components import _are_stars, components
from quantis.llm.work import give_up_shuffles


def plan_of(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()


def shuffle_files(spark):
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return sum("shuffle_" in f.getName() for f in spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(manager.getAllFiles()))


def settled(spark):
    """Shuffle files that stay when the cleaner has had time."""
    n = shuffle_files(spark)
    while True:
        time.sleep(1)
        n, before = shuffle_files(spark), n
        if n == before:
            return n


def test_rounds_of_components_leave_no_shuffle_files(spark):
    give_up_shuffles(spark)
    before = settled(spark)
    path = spark.range(1, 300).select((F.col("id") - 1).alias("a"), F.col("id").alias("b"))
    found = components(path, "a", "b")
    assert settled(spark) - before < 150  # of the steps after the last round
    assert found.select("label").distinct().count() == 1


def test_steps_and_rounds_of_personal_data_give_up_their_shuffles(spark, monkeypatch):
    calls = []
    monkeypatch.setattr("quantis.llm.work.give_up_shuffles", calls.append)
    texts = [(i, f"write to user{i}@example.org or call +44 20 7946 0{i:03d} now") for i in range(6)]
    found = pii.spans(spark.createDataFrame(texts, "doc_id long, text string"), "doc_id", "text")
    assert len(calls) >= 5  # base, instances, patterns, one round at least, result
    assert found.filter("base").count() == 12


def test_stars_are_told_from_other_edges(spark):
    def stars(*edges):
        return _are_stars(spark.createDataFrame(edges, "u long, v long"))

    assert stars((2, 1), (3, 1), (5, 4))
    assert not stars((2, 1), (3, 2))  # a path
    assert not stars((3, 1), (3, 2))  # two edges down


def test_a_large_cluster_can_be_split_where_parts_meet_it(spark):
    clusters = spark.createDataFrame([(i.to_bytes(2, "big"), b"c") for i in range(300)], "node binary, cluster binary")
    labels = spark.createDataFrame([(i.to_bytes(2, "big"), b"a" if i % 3 else b"b") for i in range(300)], "node binary, label binary")
    texts = clusters.select("node", F.lit(b"").alias("sign"), F.lit("").alias("text"))
    plan = plan_of(neardup.part_links(clusters, labels, texts, 4, 80))
    # the table of largest parts is read, not made under the join
    assert "max(struct(n" not in plan


def test_every_round_of_components_gives_up_its_shuffles(spark, monkeypatch):
    calls = []
    monkeypatch.setattr("quantis.llm.components.give_up_shuffles", calls.append)
    components(spark.createDataFrame([(1, 2), (2, 3), (3, 4)], "a long, b long"), "a", "b")
    assert calls


def test_a_design_is_made_beside_little_else():
    x = np.random.default_rng(4).random((20_000, 17))
    model = quality.Model(np.linspace(0, 1, 11) * np.ones((17, 1)), np.ones((17, 1)))
    tracemalloc.start()
    size = model.design(x).nbytes
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 1.3 * size
