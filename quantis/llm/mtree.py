"""Exact top-k search by inner product with M-trees (operator 6).

Inner product becomes a metric by one more coordinate: with M the largest
norm in a tree, x' = (x, sqrt(M^2 - |x|^2)) and q' = (q, 0) have
|q' - x'|^2 = |q|^2 + M^2 - 2 q.x, so near means high.

Vectors are dealt over trees of about ``TREE_ROWS`` by a hash.  A tree is a
table of pages: a page of entries, each with its routing vector, covering
radius and child page (or, in a leaf, a vector and its ids), and every entry's
distance from the routing vector of the page.  A query opens pages in the
order of their least possible distance.  Entries whose stored distances
already exclude them by the triangle inequality cost no distance computation;
the search ends when the next page cannot hold anything better than the k-th
hit.  Ties on the k-th score are followed, so the smaller ids win.

Queries go to the trees in blocks of ``BLOCK``; each (tree, block) pair is one
bounded group, and the best k of all trees are ranked at the end.

Equal vectors are one entry with their k + 1 least ids (one may be the
query's own); no other of their ids can be among the best k, so a vector that
a third of all rows share is no load.

Defined cases: rows whose id or vector is null, or whose vector is empty or
holds a null or non-finite component, take no part; repeated rows of one id
and vector count once; a query never finds its own id; vectors of different
lengths are not compared; an empty table gives an empty result.  Scores are
exact integers: floating-point products only bound them, with a slack for their
rounding.  A component whose scaled value, or a result whose score, leaves the
range of a long raises.  Only id and vector are read.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from quantis.llm.work import cut

TREE_ROWS, PAGE, BLOCK = 16_384, 128, 1_024
PAGES = (
    "dim int, tree int, page int, leaf boolean, largest double, parents binary, radii binary, vectors binary, children binary, "
    "ids binary, ids_first binary"
)


class Builder:
    """Bulk loading of one tree from distinct vectors."""

    def __init__(self, vectors: np.ndarray, ids: list[list[int]]):
        self.vectors, self.ids = vectors, ids
        x = vectors.astype(np.float64)
        norm = (x * x).sum(axis=1)
        self.largest = float(norm.max())
        self.lifted = np.column_stack([x, np.sqrt(self.largest - norm)])
        self.rng = np.random.Generator(np.random.PCG64(len(vectors)))
        self.pages: list[dict] = []

    def distances(self, rows: np.ndarray, to: np.ndarray) -> np.ndarray:
        # |a|^2 is the same for all lifted vectors
        return np.sqrt(np.maximum(0, 2 * self.largest - 2 * self.lifted[rows] @ self.lifted[to].T))

    def build(self, rows: np.ndarray, routing: int | None) -> int:
        """Page over ``rows``; returns its number."""
        number = len(self.pages)
        self.pages.append({})
        leaf = len(rows) <= PAGE
        if leaf:
            chosen, radii, children = rows, np.zeros(len(rows)), np.zeros(len(rows), np.int32)
        else:
            chosen = self.rng.choice(rows, min(PAGE, max(2, -(-len(rows) // PAGE))), replace=False)
            to = self.distances(rows, chosen)
            near = to.argmin(axis=1)
            for j, seed in enumerate(chosen):
                near[rows == seed] = j
            radii = np.array([to[near == j, j].max() for j in range(len(chosen))])
            children = np.array([self.build(rows[near == j], int(seed)) for j, seed in enumerate(chosen)], np.int32)
        parents = np.zeros(len(chosen)) if routing is None else self.distances(chosen, np.array([routing]))[:, 0]
        ids = [self.ids[r] for r in chosen] if leaf else []
        self.pages[number] = {
            "page": number, "leaf": leaf, "largest": self.largest, "parents": parents.tobytes(), "radii": radii.tobytes(),
            "vectors": self.vectors[chosen].tobytes(), "children": children.tobytes(),
            "ids": np.array([i for x in ids for i in x], np.int64).tobytes(),
            "ids_first": np.cumsum([0] + [len(x) for x in ids]).astype(np.int32).tobytes(),
        }
        return number


def _build(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    dim, tree = (k.as_py() for k in key)
    # by id, so that the tree does not depend on the order of rows
    table = table.take(pa.array(np.argsort([x[0] for x in table["ids"].to_pylist()], kind="stable")))
    vectors = table["vector"].combine_chunks().flatten().to_numpy().reshape(-1, dim)
    builder = Builder(vectors, table["ids"].to_pylist())
    builder.build(np.arange(len(vectors)), None)
    return pa.Table.from_pylist([{"dim": dim, "tree": tree} | p for p in builder.pages]).cast(
        pa.schema(
            [("dim", pa.int32()), ("tree", pa.int32()), ("page", pa.int32()), ("leaf", pa.bool_()), ("largest", pa.float64())]
            + [(c, pa.binary()) for c in ("parents", "radii", "vectors", "children", "ids", "ids_first")]
        )
    )


@dataclass
class Page:
    leaf: bool
    parents: np.ndarray
    radii: np.ndarray
    exact: np.ndarray
    vectors: np.ndarray
    lengths: np.ndarray
    children: np.ndarray
    ids: np.ndarray
    ids_first: np.ndarray


def exact_score(a: np.ndarray, b: np.ndarray) -> int:
    """Inner product of integer vectors, whatever its size."""
    if float(np.abs(a.astype(np.float64)) @ np.abs(b.astype(np.float64))) < 2.0**62:
        return int(a @ b)
    return sum(x * y for x, y in zip(a.tolist(), b.tolist(), strict=True))


class Tree:
    """One tree's pages, ready to be searched."""

    def __init__(self, table: pa.Table, dim: int):
        rows = sorted(table.to_pylist(), key=lambda r: r["page"])
        self.largest, self.dim, self.pages = rows[0]["largest"], dim, []
        for r in rows:
            exact = np.frombuffer(r["vectors"], np.int64).reshape(-1, dim)
            vectors = exact.astype(np.float64)
            self.pages.append(
                Page(
                    r["leaf"], np.frombuffer(r["parents"]), np.frombuffer(r["radii"]), exact, vectors, np.sqrt((vectors * vectors).sum(axis=1)),
                    np.frombuffer(r["children"], np.int32), np.frombuffer(r["ids"], np.int64), np.frombuffer(r["ids_first"], np.int32),
                )
            )

    def search(self, asked: np.ndarray, own: int, k: int) -> list[tuple[int, int]]:
        """The k best (score, id) for an integer query, its own id left out."""
        query = asked.astype(np.float64)
        square = float(query @ query)
        length = square + self.largest
        # rounding of a product, relative to both lengths, and of a distance, which is the root of one
        doubt = (self.dim + 4) * 2.0**-51
        slack = 4 * (doubt * (1 + length)) ** 0.5
        hits: list[tuple[int, int]] = []  # heap of (score, -id): the worst on top
        reach = np.inf
        heap: list[tuple[float, int, float]] = [(0.0, 0, -1.0)]
        while heap:
            least, number, to_routing = heapq.heappop(heap)
            if least > reach:
                break
            page = self.pages[number]
            if to_routing < 0:
                at = np.arange(len(page.parents))
            else:
                at = np.flatnonzero(np.abs(to_routing - page.parents) - page.radii <= reach)
            if not len(at):
                continue
            score = page.vectors[at] @ query
            if page.leaf:
                floor = float(hits[0][0]) if len(hits) == k else -np.inf
                near = score + doubt * (1 + page.lengths[at] * square**0.5) >= floor - doubt * abs(floor) if len(hits) == k else np.ones(len(at), bool)
                for e in at[near].tolist():
                    s = exact_score(page.exact[e], asked)
                    for i in page.ids[page.ids_first[e] : page.ids_first[e + 1]].tolist():
                        if i == own:
                            continue
                        if len(hits) < k:
                            heapq.heappush(hits, (s, -i))
                        elif (s, -i) > hits[0]:
                            heapq.heapreplace(hits, (s, -i))
                        else:
                            break
                if len(hits) == k:
                    reach = max(0.0, length - 2 * float(hits[0][0])) ** 0.5 + 3 * slack
            else:
                to = np.sqrt(np.maximum(0, length - 2 * score))
                bound = np.maximum(0, to - page.radii[at])
                for j in np.flatnonzero(bound <= reach):
                    heapq.heappush(heap, (float(bound[j]), int(page.children[at[j]]), float(to[j])))
        return [(s, -i) for s, i in hits]


def _search(k: int):
    def run(key: tuple[pa.Scalar, ...], pages: pa.Table, queries: pa.Table) -> pa.Table:
        found: dict[str, list] = {"query_id": [], "vec_id": [], "score": [], "query": []}
        if len(pages) and len(queries):
            tree, dim = Tree(pages, key[0].as_py()), key[0].as_py()
            vectors = queries["vector"].combine_chunks().flatten().to_numpy().reshape(-1, dim)
            for own, number, vector in zip(queries["id"].to_pylist(), queries["query"].to_pylist(), vectors, strict=True):
                for score, i in tree.search(vector, own, k):
                    if not -(1 << 63) <= score < 1 << 63:
                        raise OverflowError(f"the score of vectors {own} and {i} leaves the range of a long")
                    for name, value in zip(found, (own, i, score, number), strict=True):
                        found[name].append(value)
        return pa.table({name: pa.array(values, pa.int64()) for name, values in found.items()})

    return run


def usable(rows: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """Ids and scaled integer vectors of the rows that take part."""
    x = F.col("raw")

    def scaled(v: Column) -> Column:
        y = F.floor(v * scale)
        outside = F.abs(v * scale) >= 2.0**63
        return F.when(outside, F.raise_error(F.lit("a scaled component leaves the range of a long")).cast("long")).otherwise(y.cast("long"))

    good = x.isNotNull() & (F.size(x) > 0) & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return (
        rows.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("raw"))
        .filter(F.col("id").isNotNull() & good)
        .select("id", F.transform("raw", scaled).alias("vector"), F.size("raw").alias("dim"))
    )


def trees(rows: DataFrame, k: int) -> DataFrame:
    """Pages of all trees over the rows (id, vector, dim)."""
    least = W.partitionBy("vector").orderBy("id")
    distinct = cut(
        rows.distinct().withColumn("place", F.row_number().over(least)).filter(F.col("place") <= k + 1)
        .groupBy("dim", "vector").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    )
    n = distinct.count()
    dealt = distinct.withColumn("tree", F.pmod(F.xxhash64("vector"), F.lit(max(1, -(-n // TREE_ROWS)))).cast("int"))
    return cut(dealt.groupBy("dim", "tree").applyInArrow(_build, PAGES))


def top_k(
    vectors: DataFrame, queries: DataFrame, k: int = 5, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score`` of the k best of
    ``vectors`` for every query."""
    pages = trees(usable(vectors, id_col, vector_col, scale), k)
    asked = cut(usable(queries, id_col, vector_col, scale).distinct().withColumn("query", F.monotonically_increasing_id()))
    blocks = max(1, -(-asked.count() // BLOCK))
    known = pages.select(F.col("dim").alias("length"), F.col("tree").alias("of")).distinct()
    # every tree meets every block of queries of its length
    block = F.pmod(F.xxhash64("query"), F.lit(blocks)).cast("int")
    sides = asked.join(known, F.col("dim") == F.col("length")).select("length", "of", block.alias("block"), "id", "vector", "query")
    copies = pages.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    hits = copies.groupBy("dim", "tree", "block").cogroup(sides.groupBy("length", "of", "block")).applyInArrow(
        _search(k), "query_id long, vec_id long, score long, query long"
    )
    best = W.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    ranked = hits.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
