"""Distributed row numbers, run ids over them, and closures of adjacency lists."""

import pytest
from pyspark.sql import functions as F

from quantis import schemas as S
from quantis.operators import CycleError, descend, number_rows, run_id
from quantis.operators.numbering import RANGE, sorted_ranges
from quantis.plans.geo import facilities_by_level_ordered, org_unit_paths
from quantis.plans.unify import item_run_ids, source_ordered_items
from tests.conftest import rows


def hot(spark, n=30_000):
    """A third of the rows share one order value; read in order of ``id``."""
    return spark.range(0, n, numPartitions=7).select(
        "id", F.when(F.col("id") % 3 == 0, 500).otherwise(F.pmod(F.xxhash64("id"), F.lit(1000))).cast("long").alias("k")
    )


def test_numbers_follow_the_order_and_ties_the_reading(spark):
    got = rows(number_rows(hot(spark), "k", ranges=8), "id", "k", "row")
    expected = [(i, k, n + 1) for n, (k, i) in enumerate(sorted((k, i) for i, k in rows(hot(spark), "id", "k")))]
    assert sorted(got) == sorted(expected)


def test_a_hot_order_value_is_cut_like_any_other_rows(spark):
    sizes = [r["count"] for r in sorted_ranges(hot(spark), ["k"], 8).groupBy(RANGE).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * 30_000 / 8


def test_numbers_within_groups(spark):
    df = spark.createDataFrame(
        [("b", 2), (None, 1), ("a", 3), ("a", None), ("b", 2), ("a", 1), (None, None)] * 3, "g string, k int"
    )
    got = sorted(rows(number_rows(df, "k", by=["g"], out="n", ranges=3), "g", "k", "n"), key=str)
    found = {}
    for g, k in sorted(rows(df), key=lambda r: (r[0] is not None, r[0] or "", r[1] is not None, r[1] or 0)):
        found.setdefault(g, []).append((g, k, len(found.get(g, [])) + 1))
    assert got == sorted((x for v in found.values() for x in v), key=str)


def test_numbering_of_nothing(spark):
    assert rows(number_rows(hot(spark).filter("id < 0"), "k")) == []
    assert rows(number_rows(hot(spark).filter("id < 0"), "id", by=["k"])) == []


def test_run_ids_over_numbered_rows_with_a_hot_source_row(spark):
    items = [("s", 7 if i % 3 else i, f"item {i % 4 // 2}") for i in range(3000)]
    df = spark.createDataFrame(items, f"sub_county string, source_row long, {S.ITEM} string").repartition(5)
    got = sorted((r, item, i) for _, r, item, i in rows(item_run_ids(df, width=64)))
    expected, last, n = [], object(), 0
    for r, item in sorted((r, item) for _, r, item in items):
        n += item != last
        last = item
        expected.append((r, item, n))
    assert got == expected
    direct = run_id(df, S.ITEM, ["source_row", S.ITEM], bucket="source_row", out="id")
    assert sorted((r, item, i) for _, r, item, i in rows(direct)) == expected


def test_first_rows_in_source_order(spark):
    df = spark.createDataFrame(
        [(5, "x", "t1", "V"), (2, "x", "t2", None), (9, "y", "t1", "E"), (None, "y", "t3", "N"), (2, None, "t1", "V")],
        f"source_row long, {S.ITEM} string, tab string, ven string",
    )
    assert sorted(rows(source_ordered_items(df)), key=str) == sorted(
        [("y", "t3", "N", 1), (None, "t1", "V", 2), ("x", "t2", None, 3)], key=str
    )


def test_facility_positions_restart_in_each_county(spark):
    df = spark.createDataFrame(
        [("A", "s2", "L1", "f1"), ("A", "s1", "L3", "f77"), ("A", "s1", "L2", "f3"), ("B", "s", "L1", "f"), ("A", "s1", "L2", "f3")],
        "county string, sub_county string, keph_level string, facility_name string",
    )
    got = sorted(rows(facilities_by_level_ordered(df, {"77$": "L9"})))
    assert got == [("A", "s1", "L2", "f3", 1), ("A", "s1", "L9", "f77", 2), ("A", "s2", "L1", "f1", 3), ("B", "s", "L1", "f", 1)]


UNITS = "id string, name string, parent_id string"


def test_paths_of_any_depth(spark):
    chain = [(f"n{i}", f"unit {i}", f"n{i - 1}" if i else None) for i in range(12)]
    other = [("o", "Orphan County", "nowhere"), ("p", "Child Sub County", "o"), ("q", None, "o")]
    got = {r["id"]: (r["depth"], r["path"], r["names"]) for r in org_unit_paths(spark.createDataFrame(chain + other, UNITS)).collect()}
    assert got["n11"][0] == 11 and got["n11"][1] == "/".join(f"n{i}" for i in range(12))
    assert got["o"] == (0, "o", "Orphan") and got["p"] == (1, "o/p", "Orphan/Child") and got["q"] == (1, "o/q", "Orphan/")
    assert len(got) == 15


def test_cycles_and_repeated_ids_raise(spark):
    cyclic = spark.createDataFrame([("a", "A", None), ("b", "B", "c"), ("c", "C", "b"), ("d", "D", "c")], UNITS)
    with pytest.raises(CycleError, match="3 units .* 'b'"):
        org_unit_paths(cyclic)
    with pytest.raises(CycleError):
        descend(spark.createDataFrame([("a", "A", "a")], UNITS), "id", "parent_id", {})
    with pytest.raises(ValueError, match="listed 2 times"):
        org_unit_paths(spark.createDataFrame([("a", "A", None), ("a", "B", None)], UNITS))


def test_no_units(spark):
    assert rows(org_unit_paths(spark.createDataFrame([], UNITS))) == []
