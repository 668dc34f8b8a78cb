
import random

import pytest
from pyspark.sql import functions as F

from quantis.operators import (
    anti_join,
    crosstab,
    keep_first,
    null_safe_join,
    run_id,
    semi_join,
    top_n,
    union_aligned,
)
from quantis.schemas import OLD_CATEGORIZATION
from tests.conftest import rows


def test_null_keys_match_like_dplyr(spark):
    left = spark.createDataFrame([(None, 1), ("a", 2)], "k string, x int")
    right = spark.createDataFrame([(None, 10), ("a", 20)], "k string, y int")
    inner = null_safe_join(left, right, "k", "inner")
    assert sorted(rows(inner), key=str) == sorted([(None, 1, 10), ("a", 2, 20)], key=str)
    assert anti_join(left, right, "k").count() == 0
    assert semi_join(left, right, "k").count() == 2


def test_join_refuses_ambiguous_columns(spark):
    a = spark.createDataFrame([(1, "x")], "k int, v string")
    with pytest.raises(ValueError):
        null_safe_join(a, a, "k")


def test_join_differently_named_keys(spark):
    f = spark.createDataFrame([("F1", 5.0)], "organisation_unit string, value double")
    o = spark.createDataFrame([("F1", "Alpha")], "facility_id string, facility_name string")
    out = null_safe_join(f, o, ("organisation_unit", "facility_id"), "left")
    assert out.columns == ["organisation_unit", "value", "facility_name"]
    assert rows(out) == [("F1", 5.0, "Alpha")]


def test_crosstab_totals_fixture(spark):
    df = spark.createDataFrame(
        [("c", "A", "Product", 1.0), ("c", "A", "Equipment", 2.0), ("c", "B", "Product", 3.0)],
        "county string, tab string, poe string, v double",
    )
    out = crosstab(df, ["tab"], "poe", "v", ["Product", "Equipment"], by=["county"], row_total=True, col_total=True)
    got = {r[1]: r[2:] for r in rows(out)}
    assert got == {"A": (1.0, 2.0, 0.0, 3.0), "B": (3.0, 0.0, 0.0, 3.0), "Total": (4.0, 2.0, 0.0, 6.0)}


def test_crosstab_null_key_row_stays_apart_from_total(spark):
    df = spark.createDataFrame([("c", None, "P", 1.0), ("c", "A", "P", 2.0)], "county string, tab string, k string, v double")
    out = rows(crosstab(df, ["tab"], "k", "v", ["P"], by=["county"], row_total=True))
    assert sorted(out, key=str) == sorted([("c", None, 1.0, 0.0), ("c", "A", 2.0, 0.0), ("c", "Total", 3.0, 0.0)], key=str)


def test_crosstab_fill_and_no_fill(spark):
    df = spark.createDataFrame([("A", "x", 1.0), ("B", "y", 2.0)], "r string, k string, v double")
    filled = dict((r[0], r[1:]) for r in rows(crosstab(df, ["r"], "k", "v", ["x", "y"])))
    assert filled == {"A": (1.0, 0.0, 0.0), "B": (0.0, 2.0, 0.0)}
    sparse = dict((r[0], r[1:]) for r in rows(crosstab(df, ["r"], "k", "v", ["x", "y"], fill=False, col_total=True)))
    assert sparse == {"A": (1.0, None, None, 1.0), "B": (None, 2.0, None, 2.0)}


def test_crosstab_null_pivot_key_is_NA_column_and_discovery(spark):
    df = spark.createDataFrame([("A", None, 1.0), ("A", "x", 2.0)], "r string, k string, v double")
    out = crosstab(df, ["r"], "k", "v")
    assert out.columns == ["r", "NA", "x"]
    assert rows(out) == [("A", 1.0, 2.0)]


def test_crosstab_second_row_key_gets_dash(spark):
    df = spark.createDataFrame([("S", "W", "t", 1.0)], "sub string, ward string, k string, v double")
    out = rows(crosstab(df, ["sub", "ward"], "k", "v", ["t"], row_total=True))
    assert ("Total", "-", 1.0, 0.0) in out


@pytest.mark.parametrize("n,expected", [(1, 2), (4, 5), (6, 6)])
def test_top_n_keeps_ties(spark, n, expected):
    df = spark.createDataFrame([("g", v) for v in [5.0, 5.0, 4.0, 3.0, 3.0, None]], "g string, v double")
    assert top_n(df, "v", n, ["g"]).count() == expected


@pytest.mark.parametrize("n", [1, 2, 3, 5, 7, 9])
@pytest.mark.parametrize("smallest", [False, True])
def test_global_top_n_matches_rank(spark, n, smallest):
    vals = [5.0, 5.0, 4.0, 3.0, 3.0, None, 1.0, None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, v double")
    from pyspark.sql import Window

    o = F.col("v").asc_nulls_last() if smallest else F.col("v").desc_nulls_last()
    expect = sorted(r[0] for r in df.withColumn("r", F.rank().over(Window.orderBy(o))).where(F.col("r") <= n).collect())
    got = sorted(r[0] for r in top_n(df, "v", n, smallest=smallest).collect())
    assert got == expect


def test_top_n_without_ties_is_exact(spark):
    df = spark.createDataFrame([("g", 1.0, "a"), ("g", 1.0, "b"), ("g", 0.5, "c")], "g string, v double, name string")
    out = rows(top_n(df, "v", 1, ["g"], ties=False, tie_break=["name"]), "name")
    assert out == [("a",)]


def test_bottom_n(spark):
    df = spark.createDataFrame([("g", v) for v in [1.0, 2.0, 2.0, 3.0]], "g string, v double")
    assert sorted(r[0] for r in rows(top_n(df, "v", 2, ["g"], smallest=True), "v")) == [1.0, 2.0, 2.0]


def test_keep_first(spark):
    df = spark.createDataFrame([("i", 1, None), ("i", 2, "V"), ("j", 1, "E")], "item string, ord int, ven string")
    got = sorted(rows(keep_first(df, ["item"], ["ord"])))
    assert got == [("i", 1, None), ("j", 1, "E")]


def test_keep_first_nulls_first(spark):
    df = spark.createDataFrame([("i", "t", "V"), ("i", "t", None)], "item string, tab string, ven string")
    assert rows(keep_first(df, ["item"], ["tab", "ven"], nulls_first=["ven"])) == [("i", "t", None)]
    assert rows(keep_first(df, ["item"], ["tab", "ven"])) == [("i", "t", "V")]


def test_run_id_fixture(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(["a", "a", None, None, "a"])], "o long, v string")
    assert [r[0] for r in rows(run_id(df, "v", "o").orderBy("o"), "run_id")] == [1, 1, 2, 2, 3]


@pytest.mark.parametrize("width", [1, 3, 7, 1000])
def test_run_id_matches_brute_force_across_ranges(spark, width):
    rnd = random.Random(width)
    data = []
    for g in ("x", "y"):
        for i in range(60):
            data.append((g, i * 2, rnd.choice(["p", "q", None])))
    df = spark.createDataFrame(data, "g string, o long, v string")
    got = {(r[0], r[1]): r[2] for r in rows(run_id(df, "v", "o", ["g"], width=width), "g", "o", "run_id")}
    for g in ("x", "y"):
        seq = [d for d in data if d[0] == g]
        rid, prev = 0, object()
        for _, o, v in seq:
            if v != prev:
                rid += 1
            prev = v
            assert got[(g, o)] == rid


def test_union_aligned_null_fills_and_casts(spark):
    a = spark.createDataFrame([("i", "t")], "item_description_name_form_strength string, tab string")
    b = spark.createDataFrame([("j", "u", "Product")], "item_description_name_form_strength string, tab string, product_or_equipment string")
    out = union_aligned([a, b], OLD_CATEGORIZATION)
    assert out.columns == [f.name for f in OLD_CATEGORIZATION.fields]
    assert sorted(rows(out), key=str) == sorted([("i", "t", None), ("j", "u", "Product")], key=str)


def test_run_id_ranges_stay_bounded_with_an_outlier(spark):
    """One far value must not draw the other rows into one range."""
    df = spark.range(2000).select(F.when(F.col("id") == 1999, 10**12).otherwise(F.col("id")).alias("o"), (F.col("id") / 7).cast("int").alias("v"))
    out = run_id(df, "v", "o", width=100)
    assert [r[0] for r in rows(out.orderBy("o"), "run_id")] == [i // 7 + 1 for i in range(2000)]
    largest = df.groupBy(F.floor(F.col("o") / 100)).count().agg(F.max("count")).first()[0]
    assert largest <= 100


def test_crosstab_keeps_values_outside_the_list(spark):
    df = spark.createDataFrame(
        [("c", "t", "V", 1.0), ("c", "t", "e", 2.0), ("c", "t", None, 4.0), ("c", "u", "e", 8.0)],
        "county string, tab string, ven string, v double",
    )
    out = crosstab(df, ["tab"], "ven", "v", ["V", "E", "NA"], by=["county"], row_total=True, col_total=True)
    assert out.columns == ["county", "tab", "V", "E", "NA", "Other", "Total"]
    got = {r[1]: r[2:] for r in rows(out)}
    assert got == {"t": (1.0, 0.0, 4.0, 2.0, 7.0), "u": (0.0, 0.0, 0.0, 8.0, 8.0), "Total": (1.0, 0.0, 4.0, 10.0, 15.0)}
    with pytest.raises(ValueError):
        crosstab(df, ["tab"], "ven", "v", ["Other"])


def test_union_aligned_refuses_type_clashes(spark):
    a = spark.createDataFrame([("i", 1)], "tab string, x int")
    b = spark.createDataFrame([("i", "1")], "tab string, x string")
    with pytest.raises(TypeError):
        union_aligned([a, b])
    with pytest.raises(TypeError):
        union_aligned([spark.createDataFrame([(1,)], "tab int")], OLD_CATEGORIZATION)
