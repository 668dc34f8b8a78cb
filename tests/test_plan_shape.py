"""Physical-plan checks: the plans we want at scale, not just right answers."""

import re

import pytest

from quantis.catalog import QUERIES
from tests.conftest import SF_SMALL


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cartesian_product(spark, name):
    p = plan(QUERIES[name](spark, SF_SMALL))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_filters_and_columns_reach_the_scan(spark):
    p = plan(QUERIES["by_product_or_equipment"](spark, SF_SMALL))
    scan = [ln for ln in p.splitlines() if "FileScan parquet" in ln and "l_orderkey" in ln][0]
    assert "l_linestatus" in scan and "l_comment" not in scan and "l_shipdate" not in scan
    assert re.search(r"DataFilters: \[[^\]]*l_linestatus", scan)


def test_top_k_is_limited_before_the_shuffle(spark):
    p = plan(QUERIES["top_products"](spark, SF_SMALL))
    assert "WindowGroupLimit" in p


def test_crosstab_reads_the_fact_once(spark):
    df = QUERIES["by_product_or_equipment"](spark, SF_SMALL)
    p = plan(df)
    assert p.count("FileScan parquet") - p.count("ReusedExchange") <= 8
    assert len([ln for ln in p.splitlines() if "FileScan parquet" in ln and "l_orderkey" in ln]) == 1


def ancestors(lines: list[str], i: int) -> list[str]:
    """Operator lines above line ``i`` on its path to the root."""
    def indent(ln: str) -> int:
        return len(ln) - len(ln.lstrip(" :+-"))

    out, cur = [], indent(lines[i])
    for ln in reversed(lines[:i]):
        if indent(ln) < cur:
            out.append(ln.strip(" :+-"))
            cur = indent(ln)
    return out


@pytest.mark.parametrize("name", ["by_ven", "rmnch_share", "top_categories_by_ven", "assign_ward", "all_counties"])
def test_fact_is_never_broadcast(spark, name):
    lines = plan(QUERIES[name](spark, SF_SMALL)).splitlines()
    scans = [i for i, ln in enumerate(lines) if "FileScan parquet" in ln and "l_orderkey" in ln]
    assert scans
    for i in scans:
        assert not any(a.startswith("BroadcastExchange") for a in ancestors(lines, i)), lines[i]


def test_keep_first_is_an_aggregate_not_a_window(spark):
    p = plan(QUERIES["ven_gaps"](spark, SF_SMALL))
    assert "min_by" in p and "Window" not in p


def test_county_selection_prunes_partitions_of_a_published_table(spark, tmp_path):
    from quantis.plans.common import select_county
    from quantis.plans.unify import publish_unified

    path = str(tmp_path / "unified")
    assert publish_unified(QUERIES["all_counties"](spark, SF_SMALL), path)
    one = select_county(spark.read.parquet(path), "Asia")
    scan = [ln for ln in plan(one).splitlines() if "FileScan parquet" in ln][0]
    assert "PartitionFilters: [" in scan and "county" in scan.split("PartitionFilters: [")[1].split("]")[0]
    assert one.count() == QUERIES["county_forecasts"](spark, SF_SMALL).count()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_single_partition_stage_over_fact_rows(spark, name):
    lines = plan(QUERIES[name](spark, SF_SMALL)).splitlines()
    singles = [i for i, ln in enumerate(lines) if "Exchange SinglePartition" in ln]
    if name not in ("item_run_ids", "source_ordered_items"):
        assert not singles, name
        return
    # run ids and row numbers: the only global stages order the summary of the ranges
    for i in singles:
        below = lines[i + 1 : i + 4]
        assert any("Aggregate" in ln and ("__b" in ln or "__range" in ln) for ln in below), below

def line_exchanges(p: str) -> list[list[str]]:
    """The exchanges above each scan of lineitem."""
    lines = p.splitlines()
    scans = [i for i, ln in enumerate(lines) if "FileScan parquet" in ln and "l_orderkey" in ln]
    return [[a for a in ancestors(lines, i) if a.startswith("Exchange hashpartitioning")] for i in scans]


@pytest.mark.parametrize("name", ["all_counties_two_sources", "all_counties"])
def test_lines_are_dealt_by_order_part_and_class_only(spark, name):
    """Where no side can be broadcast, orders find their facility before they
    meet the lines, which are never dealt by customer."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        found = line_exchanges(plan(QUERIES[name](spark, SF_SMALL)))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert found
    for above in found:
        assert len(above) <= 3 and not any("custkey" in a for a in above), above


def above_lines(spark, name: str) -> list[str]:
    """The operators above the first scan of lineitem where nothing is small."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        lines = plan(QUERIES[name](spark, SF_SMALL)).splitlines()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    return ancestors(lines, next(i for i, ln in enumerate(lines) if "FileScan parquet" in ln and "l_orderkey" in ln))


def test_lines_of_all_counties_get_their_names_after_they_are_dealt_by_part(spark):
    above = above_lines(spark, "all_counties")
    by_part = [i for i, a in enumerate(above) if a.startswith("Exchange hashpartitioning(l_partkey")]
    named = [i for i, a in enumerate(above) if "BroadcastHashJoin [c_nationkey" in a]
    assert by_part and named and named[0] > by_part[0]


@pytest.mark.parametrize("name", ["all_counties", "resolve_ven_left"])
def test_lines_are_dealt_by_part_without_the_customers_key(spark, name):
    above = above_lines(spark, name)
    by_part = next(i for i, a in enumerate(above) if a.startswith("Exchange hashpartitioning(l_partkey"))
    assert "c_custkey" not in above[by_part - 1], above[by_part - 1]


@pytest.mark.parametrize("name", ["all_counties_two_sources", "all_counties", "resolve_ven_inner", "resolve_ven_left"])
def test_orders_meet_lines_by_a_shuffle_at_every_size(spark, name):
    found = line_exchanges(plan(QUERIES[name](spark, SF_SMALL)))
    assert found and all(any("l_orderkey" in a for a in above) for above in found)


def test_hot_key_join_is_split_by_aqe(spark):
    """One key holds a third of the fact rows and the dimension is too large
    to broadcast: the NULL-safe join stays a sort-merge join whose skewed
    partition AQE splits across tasks, and the result is complete."""
    from pyspark.sql import functions as F

    from quantis.operators.joins import null_safe_join

    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        n = 30000
        fact = spark.range(n).select(
            F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), (F.col("id") % 997).cast("string"))).alias("k"),
            F.col("id").alias("x"),
        )
        dim = spark.range(997).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("k"), F.col("id").alias("attr"))
        dim = dim.unionByName(spark.createDataFrame([("hot", -1)], "k string, attr long"))
        out = null_safe_join(fact, dim, "k", "left")
        assert out.count() == n
        assert out.where(F.col("k") == "hot").where(F.col("attr") == -1).count() == 10000
        out._jdf.queryExecution().toRdd().count()  # run this plan so AQE finalises it
        final = out._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in final and "skew=true" in final, final
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


#: Queries that write below the checkpoint folder and read back: numbered ranges, tree levels, landed or split tables.
WRITING = {
    "county_forecasts_discovered", "county_split_summary", "facilities_by_level_ordered", "item_run_ids", "org_unit_paths",
    "source_ordered_items", "workload_aggregate_landed",
}


def test_building_queries_runs_no_job_and_keeps_nothing(spark):
    """Builders return lazy frames; the only jobs allowed while they run read
    Parquet footers, which the same reads by hand also do, except where the
    query's own work is to write something first."""
    from quantis.sources.readers import clear_plans, read_table

    sc = spark.sparkContext
    spark.catalog.clearCache()
    before = sc._jsc.getPersistentRDDs().size()
    tables = ("lineitem", "orders", "customer", "nation", "region", "part", "events")
    for name, build in QUERIES.items():
        if name in WRITING:
            continue
        group = f"build-{name}"
        sc.setJobGroup(group, name)
        build(spark, SF_SMALL)
        built = sc.statusTracker().getJobIdsForGroup(group)
        clear_plans(spark)
        sc.setJobGroup(group + "-footers", name)
        for t in tables:
            read_table(spark, SF_SMALL, t)
        footers = len(sc.statusTracker().getJobIdsForGroup(group + "-footers"))
        assert len(built) <= footers, (name, len(built), footers)
    sc.setLocalProperty("spark.jobGroup.id", None)
    assert sc._jsc.getPersistentRDDs().size() == before


def test_plans_do_not_depend_on_cores(spark):
    """No round-robin exchange is put over a scan for the sake of local cores."""
    assert "RoundRobinPartitioning" not in plan(QUERIES["by_ven"](spark, SF_SMALL))


@pytest.mark.parametrize("name", ["all_counties", "county_summary"])
def test_both_schemas_come_from_one_scan(spark, name):
    p = plan(QUERIES[name](spark, SF_SMALL))
    assert len([ln for ln in p.splitlines() if "FileScan parquet" in ln and "l_orderkey" in ln]) == 1


def test_county_summary_joins_no_classification(spark):
    p = plan(QUERIES["county_summary"](spark, SF_SMALL))
    assert "LeftOuter" not in p and "p_brand" not in p


def test_run_ids_read_the_fact_twice_at_most(spark):
    p = plan(QUERIES["item_run_ids"](spark, SF_SMALL))
    assert len([ln for ln in p.splitlines() if "FileScan parquet" in ln and "l_orderkey" in ln]) <= 2


def test_facts_are_not_dealt_for_small_ward_lookups(spark):
    """What the hierarchy is estimated at is a product; its written size is known."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    spark.conf.set(key, "256k")
    try:
        lines = plan(QUERIES["assign_ward"](spark, SF_SMALL)).splitlines()
    finally:
        spark.conf.unset(key)
    fact = [i for i, ln in enumerate(lines) if "FileScan parquet" in ln and "l_orderkey" in ln]
    assert fact and not any("Exchange" in a and "facility_name" in a for i in fact for a in ancestors(lines, i))
