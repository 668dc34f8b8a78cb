"""Pipelines on hand-made fixtures (FIXTURES.md section 2) and properties."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from quantis import schemas as S
from quantis.operators.sets import conform
from quantis.plans import classify as C
from quantis.plans import geo as G
from quantis.plans import reports as R
from quantis.plans import unify as U
from quantis.plans import workload as W
from tests.conftest import rows

IT = S.ITEM
VAL = S.VALUE


def forecasts(spark, data):
    """Rows of (county, sub_county, facility_name, tab, ven, funding, item,
    qty, price, value); other columns NULL."""
    cols = "county string, sub_county string, facility_name string, tab string, ven string, funding string, " \
           f"{IT} string, {S.QTY} double, price_kes double, {VAL} double"
    made = spark.createDataFrame(data, cols).withColumn(VAL, F.col(VAL).cast(S.FORECASTS[VAL].dataType))
    return conform(made, S.FORECASTS)


def test_product_defaults_fixture(spark):
    f = forecasts(spark, [
        ("c", "s", "f", "10.Physiotherapy", "V", "County", "i1", 1.0, 1.0, 1.0),
        ("c", "s", "f", "4.Laboratory", "V", "County", "i2", 1.0, 2.0, 2.0),
        ("c", "s", "f", "9.Other", "V", "County", "i3", 1.0, 4.0, 4.0),
        ("c", "s", "f", "9.Other", "V", "Partner", "i3", 1.0, 8.0, 8.0),
    ])
    classes = conform(spark.createDataFrame([], f"{IT} string, tab string"), S.CLASSIFICATIONS)
    out = {r[1]: r[2:] for r in rows(C.by_product_or_equipment(f, classes))}
    assert out["Physiotherapy"] == (0.0, 1.0, 0.0, 0.0, 1.0)
    assert out["Laboratory"] == (2.0, 0.0, 0.0, 0.0, 2.0)
    assert out["Other"] == (0.0, 0.0, 4.0, 0.0, 4.0)
    assert out["Total"] == (2.0, 1.0, 4.0, 0.0, 7.0)


def test_resolve_ven_left_and_inner(spark):
    f = forecasts(spark, [
        ("c", "s", "f", "t", "V", "County", "a", 1.0, 1.0, 1.0),
        ("c", "s", "f", "t", None, "County", "b", 1.0, 1.0, 1.0),
        ("c", "s", "f", "t", None, "County", "z", 1.0, 1.0, 1.0),
    ])
    nc = spark.createDataFrame([("b", "t", "E", "Product"), ("a", "t", "N", "Product")],
                               "item_name string, product_category string, ven string, product_or_equipment string")
    left = sorted(rows(C.resolve_ven(f, nc, "left"), IT, "ven"))
    assert left == [("a", "V"), ("b", "E"), ("z", None)]
    inner = sorted(rows(C.resolve_ven(f, nc, "inner"), IT, "ven"))
    assert inner == [("a", "V"), ("b", "E")]


def test_sanitise_ven(spark):
    df = spark.createDataFrame([("V",), ("e",), ("x",), (None,)], "ven string")
    assert [r[0] for r in rows(C.sanitise_ven(df))] == ["V", None, None, None]


def org_fixture(spark):
    return spark.createDataFrame(
        [
            ("KE", "Kenya", None),
            ("C1", "Alpha County", "KE"),
            ("S1", "S Sub County", "C1"),
            ("W1", "W Ward", "S1"),
            ("F1", "F", "W1"),
            ("F2", "G", "W1"),
        ],
        "id string, name string, parent_id string",
    )


def test_hierarchy_fixture(spark):
    ou = org_fixture(spark)
    counties = G.resolve_county_id(ou, "KE", "alpha")
    assert rows(counties) == [("C1", "Alpha")]
    h = G.flatten_hierarchy(ou, counties)
    assert sorted(rows(h, "facility_name", "ward", "sub_county")) == [("F", "W", "S"), ("G", "W", "S")]


def test_assign_ward_override_wins(spark):
    ou = org_fixture(spark)
    h = G.flatten_hierarchy(ou, G.resolve_county_id(ou, "KE"))
    f = forecasts(spark, [
        ("Alpha", "S", "F", "1.T", "V", "County", "i", 1.0, 1.0, 1.0),
        ("Alpha", "S", "G", "1.T", "V", "County", "i", 1.0, 1.0, 1.0),
        ("Alpha", "S", "H", "1.T", "V", "County", "i", 1.0, 1.0, 1.0),
    ])
    out = dict(rows(G.assign_ward(f, h, {"G": "Y"}), "facility_name", "ward"))
    assert out == {"F": "W", "G": "Y", "H": None}
    missing = rows(G.facilities_without_ward(f, h, {"G": "Y"}), "facility_name")
    assert missing == [("H",)]


def test_requirements_by_ward_equals_row_level_assignment(spark):
    ou = org_fixture(spark)
    h = G.flatten_hierarchy(ou, G.resolve_county_id(ou, "KE"))
    f = forecasts(spark, [
        ("Alpha", "S", "F", "1.T", "V", "County", "i", 1.0, 1.0, 1.5),
        ("Alpha", "S", "F", "2.U", "V", "County", "i", 1.0, 1.0, 2.5),
        ("Alpha", "S", "H", "1.T", "V", "County", "i", 1.0, 1.0, 4.0),
        ("Alpha", "S", "H", "1.T", "V", "Partner", "i", 1.0, 1.0, 8.0),
    ])
    out = {(r[1], r[2]): r[3:] for r in rows(G.requirements_by_ward(f, h, None, totals=True))}
    assert out[("S", "W")] == (1.5, 2.5, 4.0)
    assert out[("S", None)] == (4.0, 0.0, 4.0)
    assert out[("Total", "-")] == (5.5, 2.5, 8.0)


def test_workload_enrich_fixture(spark):
    agg = spark.createDataFrame(
        [("F1", "O0", "K0", 5.0), ("F9", "O0", "K0", 7.0), ("F1", "O0", "K9", 1.0), ("F1", "O1", "K0", 2.0)],
        "organisation_unit string, facility_ownership string, keph_level string, value double",
    )
    ou = spark.createDataFrame([("F1", "One", "Wd", "Sc", "Co", "100")], S.ORGANISATION_UNITS)
    lv = spark.createDataFrame([("K0", "KEPH Level 2")], S.KEPH_LEVELS)
    own = spark.createDataFrame([("O0", "MoH long", "Ministry of Health"), ("O1", "Pvt", "Private")], S.FACILITY_OWNERSHIPS)
    out = sorted(rows(W.workload_enrich(agg, ou, lv, own), "facility_id", "facility_name", "total_workload"), key=str)
    assert out == sorted([("F1", "One", 5.0), ("F9", None, 7.0)], key=str)


def test_workload_aggregate_drops_range(spark):
    a = spark.createDataFrame([("d", "2024", "F1", "O0", "K0", 1.5, 1.0, 1.0, 1.0, 1.0, 1.0),
                               ("d", "2024", "F1", "O0", "K0", None, 1.0, 1.0, 1.0, 1.0, 1.0)], S.ANALYTICS)
    out = W.workload_aggregate(a)
    assert out.columns == ["organisation_unit", "facility_ownership", "keph_level", "value"]
    assert rows(out) == [("F1", "O0", "K0", 1.5)]


def test_publish_once_keeps_first_rows(spark):
    d = tempfile.mkdtemp(prefix="quantis-publish-")
    path = os.path.join(d, "unified")
    first = spark.createDataFrame([("A", 1)], "county string, x int")
    second = spark.createDataFrame([("B", 2)], "county string, x int")
    assert U.publish_unified(first, path) is True
    assert U.publish_unified(second, path) is False
    assert rows(spark.read.parquet(path), "county", "x") == [("A", 1)]


def test_publish_once_leaves_an_unmarked_table_alone(spark):
    """A table whose writer makes no commit marker is not overwritten."""
    from quantis.sources.sinks import publish_once

    path = os.path.join(tempfile.mkdtemp(prefix="quantis-publish-"), "unified")
    first = spark.createDataFrame([("A", 1)], "county string, x int")
    first.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").partitionBy("county").parquet(path)
    assert not os.path.exists(os.path.join(path, "_SUCCESS"))
    df = spark.createDataFrame([("B", 2)], "county string, x int")
    with pytest.raises(FileExistsError):
        U.publish_unified(df, path)
    assert rows(spark.read.parquet(path), "county", "x") == [("A", 1)]
    # replacing it is a caller's explicit decision, and moves the old one aside
    assert publish_once(df, path, replace_unmarked=True) is True
    assert rows(spark.read.parquet(path), "county", "x") == [("B", 2)]
    moved = [x for x in os.listdir(os.path.dirname(path)) if x.startswith("unified.replaced-")]
    assert rows(spark.read.parquet(os.path.join(os.path.dirname(path), moved[0])), "county", "x") == [("A", 1)]


def test_two_sources_harmonise_to_the_one_scan_binding(spark):
    from quantis.sources import binding as B

    base = "/root/testdata/sf0.001"
    two = U.union_harmonised(B.forecasts(spark, base), B.forecasts_tn(spark, base), B.DIVERGENT_COUNTY)
    one = B.harmonised(spark, base)
    assert two.columns == one.columns
    assert sorted(map(str, two.collect())) == sorted(map(str, one.collect()))


def test_crosstab_totals_reconcile_with_the_grand_total(spark):
    """No report loses money: its total cell is the county's grand total."""
    from quantis.catalog import QUERIES

    base = "/root/testdata/sf0.001"
    grand = {r[0]: round(r[1], 2) for r in QUERIES["county_grand_total"](spark, base).collect()}
    for name in ("by_product_or_equipment", "by_ven", "rmnch_value_pct"):
        got = {r["county"]: round(r["Total"], 2) for r in QUERIES[name](spark, base).where("tab = 'Total'").collect()}
        assert got == grand, name


def test_override_with_two_wards_fails(spark):
    f = forecasts(spark, [("Alpha", "S", "F", "1.T", "V", "County", "i", 1.0, 1.0, 1.0)])
    h = spark.createDataFrame([("Alpha", "S", "F", "W")], "county string, sub_county string, facility_name string, ward string")
    twice = spark.createDataFrame([("F", "X"), ("F", "Y")], "facility_name string, ward string")
    with pytest.raises(Exception, match="two override wards"):
        G.assign_ward(f, h, twice).collect()


def test_split_by_county_partitions(spark):
    d = tempfile.mkdtemp(prefix="quantis-split-")
    df = spark.createDataFrame([("A", 1), ("B", 2), ("A", 3)], "county string, x int")
    U.split_by_county(df, d)
    assert sorted(x for x in os.listdir(d) if x.startswith("county=")) == ["county=A", "county=B"]
    assert spark.read.parquet(d).where(F.col("county") == "A").count() == 2


def test_partitioned_write_splits_a_hot_county(spark):
    from quantis.sources.sinks import rebalanced

    d = tempfile.mkdtemp(prefix="quantis-skew-")
    hot = spark.range(30000).select(F.lit("Hot").alias("county"), F.col("id").alias("x"))
    cold = spark.range(100).select(F.concat(F.lit("C"), (F.col("id") % 5).cast("string")).alias("county"), F.col("id").alias("x"))
    df = hot.unionByName(cold)
    assert "RebalancePartitions" in rebalanced(df, ["county"])._jdf.queryExecution().optimizedPlan().toString()
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16k")
    try:
        U.split_by_county(df, d)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    hot_files = [f for f in os.listdir(os.path.join(d, "county=Hot")) if f.endswith(".parquet")]
    assert len(hot_files) > 1  # the hot county was written by several tasks
    back = spark.read.parquet(d)
    assert back.count() == 30100 and back.where(F.col("county") == "Hot").count() == 30000


def test_facilities_by_level_override(spark):
    f = forecasts(spark, [("c", "s", "Merti Sub County Hospital", "1.T", "V", "County", "i", 1.0, 1.0, 1.0)])
    f = f.withColumn("keph_level", F.lit("KEPH Level 3"))
    out = rows(G.facilities_by_level(f, {"Merti Sub": "KEPH Level 4"}), "keph_level")
    assert out == [("KEPH Level 4",)]


def test_rmnch_share_fixture(spark):
    f = forecasts(spark, [
        ("c", "s", "f", "1.T", "V", "County", "y", 1.0, 1.0, 1.0),
        ("c", "s", "f", "1.T", "V", "County", "n", 1.0, 1.0, 2.0),
        ("c", "s", "f", "2.U", "V", "County", "y", 1.0, 1.0, 0.0),
    ])
    classes = conform(spark.createDataFrame([("y", "1.T", "Yes"), ("y", "2.U", "Yes")],
                                            f"{IT} string, tab string, rmnch_product string"), S.CLASSIFICATIONS)
    out = {r[1]: r[2:] for r in rows(R.rmnch_share(f, classes))}
    assert out["T"] == (0.33, 0.67, 0.0, "33%", 1.0)
    assert out["U"] == (0.0, 0.0, 0.0, None, 0.0)  # 0/0: NULL share (documented deviation from NaN)
    assert out["Total"] == (0.33, 0.67, 0.0, "-", 1.0)
    summary = rows(R.rmnch_summary(f, classes))
    assert summary == [("c", 1.0, 2.0, 0.0, 3.0)]


def test_report_pack_from_one_shared_cube_equals_fact_reports(spark):
    from quantis.catalog import KEPH_LEVELS, QUERIES
    from quantis.sources import binding as B

    base = "/root/testdata/sf0.001"
    f = B.forecasts(spark, base)
    assert U.report_cube(f, materialize=False).count() < f.count()
    pack = R.product_report_pack(
        f, B.product_classifications(spark, base), B.new_product_categorization(spark, base), levels=KEPH_LEVELS
    )
    assert len(pack) == 11
    for name, df in pack.items():
        expect = QUERIES[name](spark, base)
        got = df.select(*[F.col(f"`{c}`").cast("double").alias(c) if t.startswith("decimal") else F.col(f"`{c}`")
                          for c, t in df.dtypes])
        assert got.columns == expect.columns, name
        assert sorted(rows(got), key=str) == sorted(rows(expect), key=str), name
