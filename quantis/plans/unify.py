"""All-counties harmonisation, county selection, splitting and publishing."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quantis import schemas as S
from quantis.functions.values import money_total, ven_or_null
from quantis.operators.columns import clean_names
from quantis.operators.joins import null_safe_join
from quantis.operators.numbering import number_rows
from quantis.operators.sets import union_aligned
from quantis.operators.windows import RUN_ID_RANGE, run_id
from quantis.plans.common import recomputed_value, select_county
from quantis.session import ensure_checkpoint_dir
from quantis.sources.sinks import partition_values, publish_once, write_partitioned

CLASS_ATTRS = ("product_or_equipment", "product_classification", "rmnch_product", "moh_647_name")


# Grain of the shared report cube: every product report groups by a subset
# of these keys.
CUBE_KEYS = ("county", "tab", S.ITEM, "ven", "funding", "keph_level")


def report_cube(forecasts: DataFrame, materialize: bool = True) -> DataFrame:
    """One pass over the forecasts for a whole pack of product reports.

    Value is summed per (county, tab, item, VEN, funding, level): map-side
    partial aggregation, one small shuffle.  Every product report (P5, P9,
    P10, P11-P13, P20, P22-P24) accepts the cube in place of the forecasts
    and gives the same result, since the reports only re-sum the value and
    exact decimal sums of sums are the sums.  ``materialize`` writes it
    with ``checkpoint()`` to the cluster's ``spark.checkpoint.dir`` (shared
    storage), cutting the lineage so the reports neither rescan the fact nor
    recompute it after an executor loss."""
    cube = forecasts.groupBy(*CUBE_KEYS).agg(money_total(S.VALUE).alias(S.VALUE))
    if materialize:
        ensure_checkpoint_dir(forecasts.sparkSession)
        cube = cube.checkpoint(eager=False)  # written by the first report that runs
    return cube


def county_forecasts(forecasts: DataFrame, county: str) -> DataFrame:
    """Every forecast row of one county (all its sub-county tables)."""
    return select_county(forecasts, county)


def harmonise_tn(forecasts_tn: DataFrame, county_name: str) -> DataFrame:
    """Divergent schema -> common schema: forced county name, VEN outside
    {V, E, N} -> NULL, ``pack_size.x`` -> pack_size, new price -> price,
    value recomputed from the new price."""
    return forecasts_tn.select(
        F.lit(county_name).alias("county"),
        "sub_county", "facility_type", "facility_name", "sub_category", "keph_level", "tab",
        ven_or_null("ven").alias("ven"),
        "funding",
        S.ITEM,
        F.col(f"`{S.PACK_X}`").alias("pack_size"),
        F.col(S.NEW_PRICE).alias("price_kes"),
        S.QTY,
        recomputed_value(S.NEW_PRICE).alias(S.VALUE),
        S.BUFFER,
        S.PROCURE,
        "contains_lab",
    )


def harmonise(forecasts: DataFrame) -> DataFrame:
    """Common-schema counties: value recomputed as quantity x price."""
    return forecasts.withColumn(S.VALUE, recomputed_value())


def union_harmonised(forecasts: DataFrame, forecasts_tn: DataFrame, tn_county: str) -> DataFrame:
    """Both sources in one schema (UNION ALL, types checked against the
    declared schema)."""
    return union_aligned([harmonise_tn(forecasts_tn, tn_county), harmonise(forecasts)], S.FORECASTS)


def classified(harmonised: DataFrame, classes: DataFrame) -> DataFrame:
    """Harmonised forecasts classified on (item, tab) with a NULL-safe left
    join to the classification sheet after snake-casing its column names."""
    cls = clean_names(classes).select(S.ITEM, "tab", *CLASS_ATTRS)
    return null_safe_join(harmonised, cls, [S.ITEM, "tab"], "left")


def all_counties(forecasts: DataFrame, forecasts_tn: DataFrame, classes: DataFrame, tn_county: str) -> DataFrame:
    """Both sources in one schema, classified."""
    return classified(union_harmonised(forecasts, forecasts_tn, tn_county), classes)


def distinct_counties(master: DataFrame) -> DataFrame:
    """The counties of the master list."""
    return master.select("county").distinct()


def split_by_county(df: DataFrame, path: str) -> None:
    """One output partition per county (``group_split``)."""
    write_partitioned(df, path, ("county",))


def county_split_summary(forecasts: DataFrame, path: str) -> DataFrame:
    """P4 and back: publishes the forecasts split by county at ``path``, then
    reads every county by itself; rows and value of each county and
    sub-county.  The counties are taken from the directory names, and each
    county's predicate prunes its scan to one directory."""
    spark = forecasts.sparkSession
    split = forecasts.select("county", "sub_county", S.VALUE)
    publish_unified(split, path)
    table = spark.read.schema(split.schema).parquet(path)
    parts = [
        select_partition(table, c).groupBy("county", "sub_county").agg(
            F.count(F.lit(1)).alias("n_rows"), money_total(S.VALUE).alias(S.VALUE)
        )
        for c in partition_values(spark, path, "county")
    ]
    none = table.limit(0).groupBy("county", "sub_county").agg(F.count(F.lit(1)).alias("n_rows"), money_total(S.VALUE).alias(S.VALUE))
    return reduce(DataFrame.union, parts) if parts else none


def select_partition(table: DataFrame, county: str | None) -> DataFrame:
    """One county of a split table by its directory; None: rows without one."""
    return table.where(F.col("county").eqNullSafe(F.lit(county)))


def publish_unified(unified: DataFrame, path: str) -> bool:
    """Write the unified table only if it does not exist yet."""
    return publish_once(unified, path, ("county",))


def item_run_ids(forecasts_tn: DataFrame, width: int = RUN_ID_RANGE) -> DataFrame:
    """``consecutive_id(item)`` over the divergent county's rows in source
    order: one sequence over the concatenated sub-county tables.  Only the
    columns of the result are read.  The rows are numbered first, so a range
    of the run ids holds ``width`` rows, also where many share a source row."""
    rows = number_rows(forecasts_tn.select("sub_county", "source_row", S.ITEM), ["source_row", S.ITEM], out="__row")
    return run_id(rows, S.ITEM, "__row", width=width, out="id").drop("__row")


def source_ordered_items(forecasts_tn: DataFrame) -> DataFrame:
    """The first row of each item in source order (``distinct(item,
    .keep_all = TRUE)`` over the concatenated tables): item, tab, VEN and its
    ``position`` among all rows."""
    read = forecasts_tn.select("source_row", S.ITEM, "tab", "ven")
    rows = number_rows(read, ["source_row", S.ITEM, "tab", "ven"], out="position")
    first = rows.groupBy(S.ITEM).agg(F.min_by(F.struct("tab", "ven", "position"), "position").alias("first"))
    return first.select(S.ITEM, "first.tab", "first.ven", "first.position")
