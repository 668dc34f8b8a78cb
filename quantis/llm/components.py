"""Connected components by alternating large and small stars.

In a large star every node links its larger neighbours to the least node it
knows; in a small star its smaller ones.  Both keep connectivity, and the
edges shrink towards one star for each component.  All steps are grouped
minima and joins.  The minima combine before the shuffle; they are written
before they are joined, so the join deals the edges through an exchange of its
own, and AQE can split a node that holds a third of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quantis.llm.work import cut, give_up_shuffles


def _both_ways(edges: DataFrame) -> DataFrame:
    """Every edge from either end, in one reading: node, other, and whether
    the other is the lesser."""
    def way(node: str, other: str, down: int) -> Column:
        return F.struct(F.col(node).alias("node"), F.col(other).alias("other"), F.lit(down).alias("down"))

    return edges.select(F.inline(F.array(way("u", "v", 1), way("v", "u", 0))))


def _large_star(edges: DataFrame) -> DataFrame:
    both = _both_ways(edges).select(F.col("node").alias("u"), F.col("other").alias("v"))
    least = cut(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
    return both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = cut(edges.groupBy("u").agg(F.min("v").alias("m")))
    inner = edges.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return inner.union(least.select("u", F.col("m").alias("v"))).distinct()


def _are_stars(edges: DataFrame) -> bool:
    """Whether each node has a single edge down, or only edges up."""
    ends = _both_ways(edges).groupBy("node").agg(F.sum("down").alias("down"), F.count(F.lit(1)).alias("n"))
    return ends.filter("down > 1 or (down = 1 and n > 1)").isEmpty()


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``node`` and ``label`` (the least node of its component) of every node
    that occurs in an edge."""
    now = cut(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u is not null and v is not null").distinct()
    )
    nodes = now
    now = now.filter("u != v")
    while not _are_stars(now):
        now = cut(_small_star(cut(_large_star(now))))  # a small star reads its edges twice
        give_up_shuffles(edges.sparkSession)  # a round's small files are many where tasks are
    ends = now.select(F.col("u").alias("node"), F.col("v").alias("label"))
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    alone = nodes.filter("u = v").select(F.col("u").alias("node"), F.col("v").alias("label"))
    found = ends.union(roots)
    return cut(found.union(alone.join(found, "node", "left_anti")))
