"""Registered queries over the bound test tables.

``QUERIES[name](spark, base_dir) -> DataFrame`` runs one pipeline on the
whole bound tables of ``base_dir`` (all counties at once).  Results leave
money as double (exact decimal sums converted at the edge).
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from quantis.functions.text import title_case
from quantis.operators.columns import snake_case
from quantis.plans import classify as C
from quantis.plans import geo as G
from quantis.plans import reports as R
from quantis.plans import unify as U
from quantis.plans import workload as W
from quantis.plans.common import select_county
from quantis.session import ensure_checkpoint_dir
from quantis.sources import binding as B
from quantis.sources.readers import catalog_union, clear_plans
from quantis.sources.sinks import partition_values, write_partitioned

Query = Callable[[SparkSession, str], DataFrame]

# Parameters of the registered queries.
ONE_COUNTY = "asia"
WORKLOAD_PERIOD = "2024"
WORKLOAD_ELEMENTS = ("signup", "view", "click", "purchase")
WORKLOAD_OWNERSHIPS = ("O0", "O1", "O2")
WORKLOAD_LEVELS = ("K0", "K1", "K2", "K3", "K4")
SOME_OWNERSHIPS = ("O0", "O2")
SOME_LEVELS = ("K1", "K2", "K4")
KEPH_LEVELS = tuple(f"KEPH Level {i}" for i in range(2, 7))
# clean labels of the forecast tabs, in column order of the ward reports
WARD_TABS = (
    "3Oncology", "4Immunisation", "Dental", "Laboratory", "Maternity", "Non-Pharmaceuticals", "Nutrition", "Ophthalmology",
    "Orthopaedics", "Pharmaceuticals", "Physiotherapy", "Radiology", "Renal", "Theatre",
)
LEVEL_OVERRIDES = {"77$": "KEPH Level 4"}
SEARCH_PATTERN = "#0+1[0-9]$"
SEARCH_SUB_COUNTY = "NATION_3"


def edge(df: DataFrame) -> DataFrame:
    """Report edge: decimal money -> double."""
    cols = [
        F.col(f"`{f.name}`").cast("double").alias(f.name) if isinstance(f.dataType, DecimalType) else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ]
    return df.select(*cols)


def _hierarchy(spark: SparkSession, base: str) -> DataFrame:
    ou = B.org_units(spark, base)
    return G.flatten_hierarchy(ou, G.resolve_county_id(ou, B.ROOT_ID))


def _lookup(spark: SparkSession, df: DataFrame) -> DataFrame:
    """A lookup table written below the checkpoint folder.  What joins and
    distincts make of it is estimated at the product of its inputs, and every
    fact row is dealt for a join that turns out to need none; the size of a
    written table is known when the join is planned."""
    path = _scratch(spark, "lookup")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _assigned(spark: SparkSession, base: str) -> DataFrame:
    hierarchy, overrides = (_lookup(spark, x) for x in (_hierarchy(spark, base), B.ward_overrides(spark, base)))
    return G.assign_ward(B.forecasts(spark, base), hierarchy, overrides)


def _tn_titled(spark: SparkSession, base: str) -> DataFrame:
    return B.forecasts_tn(spark, base).withColumn("county", title_case("county"))


def _workload_agg(spark: SparkSession, base: str) -> DataFrame:
    ext = W.workload_extract(
        B.analytics(spark, base), WORKLOAD_PERIOD, WORKLOAD_ELEMENTS, WORKLOAD_OWNERSHIPS, WORKLOAD_LEVELS
    )
    return W.workload_aggregate(ext)


def _scratch(spark: SparkSession, name: str) -> str:
    """A folder of its own below the checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _discovered(spark: SparkSession, base: str, county: str) -> DataFrame:
    """One table for each sub-county of every county, named as the source
    database names them, of which a county's are found by their suffix."""
    path, mark = _scratch(spark, "tables"), f"t{uuid.uuid4().hex}"
    forecasts = B.forecasts(spark, base)
    write_partitioned(forecasts.withColumn("of", F.concat_ws("_", "sub_county", F.lower("county"))), path, ("of",))
    tables = {f"{mark}_{snake_case(of)}": of for of in partition_values(spark, path, "of")}
    for name, of in tables.items():
        spark.read.schema(forecasts.schema).parquet(f"{path}/of={of}").createOrReplaceTempView(name)
    found = catalog_union(spark, f"{mark}_.*_{county}", forecasts.schema)
    for name in tables:
        spark.catalog.dropTempView(name)
    return found


def _landed(spark: SparkSession, base: str) -> str:
    """The workload extract landed as CSV files whose columns come in two
    orders and spellings, as two versions of the API would write them."""
    path = _scratch(spark, "landed")
    extract = B.analytics(spark, base)
    old = F.pmod(F.xxhash64("organisation_unit"), F.lit(2)) == 0
    titled = [F.col(c).alias(c.replace("_", " ").capitalize()) for c in extract.columns]
    camel = [F.col(c).alias(re.sub("_(.)", lambda m: m[1].upper(), c)) for c in reversed(extract.columns)]
    extract.where(old).select(*titled).write.option("header", True).csv(f"{path}/old")
    extract.where(~old).select(*camel).write.option("header", True).option("compression", "gzip").csv(f"{path}/new")
    return path


def _workload_landed(spark: SparkSession, base: str) -> DataFrame:
    ext = W.workload_extract(
        W.landed_extract(spark, _landed(spark, base)), WORKLOAD_PERIOD, WORKLOAD_ELEMENTS, WORKLOAD_OWNERSHIPS, WORKLOAD_LEVELS
    )
    return W.workload_aggregate(ext)


def _workload_enriched(spark: SparkSession, base: str) -> DataFrame:
    return W.workload_enrich(
        _workload_agg(spark, base),
        B.organisation_units(spark, base),
        B.keph_levels(spark),
        B.facility_ownerships(spark),
    )


def _products_tn(spark: SparkSession, base: str) -> DataFrame:
    return R.products_by_category_tn(B.forecasts_tn(spark, base))


_RAW: dict[str, Query] = {
    # P1 / P2 / P3 / P4
    "county_forecasts": lambda s, b: U.county_forecasts(B.forecasts(s, b), ONE_COUNTY),
    "county_forecasts_discovered": lambda s, b: _discovered(s, b, ONE_COUNTY),
    "all_counties": lambda s, b: U.classified(B.harmonised(s, b), B.product_classifications(s, b)),
    "county_summary": lambda s, b: R.county_summary(B.harmonised(s, b)),
    "all_counties_two_sources": lambda s, b: U.all_counties(
        B.forecasts(s, b), B.forecasts_tn(s, b), B.product_classifications(s, b), B.DIVERGENT_COUNTY
    ),
    "county_summary_two_sources": lambda s, b: R.county_summary_of(
        [U.harmonise_tn(B.forecasts_tn(s, b), B.DIVERGENT_COUNTY), U.harmonise(B.forecasts(s, b))]
    ),
    "county_split_summary": lambda s, b: U.county_split_summary(B.forecasts(s, b), _scratch(s, "split")),
    "distinct_counties": lambda s, b: U.distinct_counties(B.master(s, b)),
    # P5 / P6
    "by_product_or_equipment": lambda s, b: C.by_product_or_equipment(
        B.forecasts(s, b), B.product_classifications(s, b)
    ),
    "by_product_or_equipment_tn": lambda s, b: C.by_product_or_equipment_tn(
        B.forecasts_tn(s, b), B.product_classifications(s, b)
    ),
    "by_product_or_equipment_tn_measures": lambda s, b: C.by_product_or_equipment_tn_measures(
        B.forecasts_tn(s, b), B.product_classifications(s, b)
    ),
    # P7 / P8 / P9 / P10
    "resolve_ven_left": lambda s, b: C.resolve_ven(B.forecasts(s, b), B.new_product_categorization(s, b), "left"),
    "resolve_ven_inner": lambda s, b: C.resolve_ven(B.forecasts(s, b), B.new_product_categorization(s, b), "inner"),
    "sanitise_ven": lambda s, b: C.sanitise_ven(B.forecasts_tn(s, b)),
    "by_ven": lambda s, b: C.by_ven(B.forecasts(s, b), B.new_product_categorization(s, b)),
    "by_ven_map": lambda s, b: C.by_ven_map(B.forecasts(s, b), B.new_product_categorization(s, b)).select(
        "county", "tab", F.explode("cells").alias("ven", "value"), "Total"
    ),
    "by_ven_inner_recomputed": lambda s, b: C.by_ven(
        B.forecasts(s, b), B.new_product_categorization(s, b), how="inner", value="recomputed"
    ),
    "by_ven_tn": lambda s, b: C.by_ven_tn(B.forecasts_tn(s, b), B.new_product_categorization(s, b)),
    "ven_totals": lambda s, b: R.ven_totals(B.forecasts(s, b)),
    "ven_totals_resolved": lambda s, b: R.ven_totals_resolved(B.forecasts(s, b), B.new_product_categorization(s, b)),
    # P11 / P12 / P13
    "rmnch_share": lambda s, b: R.rmnch_share(B.forecasts(s, b), B.product_classifications(s, b)),
    "rmnch_value_pct": lambda s, b: R.rmnch_value_pct(B.forecasts(s, b), B.product_classifications(s, b)),
    "rmnch_summary": lambda s, b: R.rmnch_summary(B.forecasts(s, b), B.product_classifications(s, b)),
    # P14 - P19
    "resolve_county_id": lambda s, b: G.resolve_county_id(B.org_units(s, b), B.ROOT_ID),
    "resolve_one_county_id": lambda s, b: G.resolve_county_id(B.org_units(s, b), B.ROOT_ID, ONE_COUNTY),
    "flatten_hierarchy": _hierarchy,
    "org_unit_paths": lambda s, b: G.org_unit_paths(B.org_units(s, b)),
    "assign_ward": _assigned,
    "requirements_by_ward": lambda s, b: G.requirements_by_ward(
        B.forecasts(s, b), _hierarchy(s, b), B.ward_overrides(s, b), tabs=WARD_TABS
    ),
    "requirements_by_ward_totals": lambda s, b: G.requirements_by_ward(
        B.forecasts(s, b), _hierarchy(s, b), B.ward_overrides(s, b), value="recomputed", totals=True, tabs=WARD_TABS
    ),
    "requirements_by_ward_tn": lambda s, b: G.requirements_by_ward(
        _tn_titled(s, b), _hierarchy(s, b), B.ward_overrides(s, b), value="new_price", tabs=WARD_TABS
    ),
    "unmatched_facilities": lambda s, b: G.unmatched_facilities(B.forecasts(s, b), B.org_units(s, b)),
    "facilities_without_ward": lambda s, b: G.facilities_without_ward(
        B.forecasts(s, b), _hierarchy(s, b), B.ward_overrides(s, b)
    ),
    "facilities_by_level": lambda s, b: G.facilities_by_level(B.forecasts(s, b), LEVEL_OVERRIDES),
    "facilities_by_level_ordered": lambda s, b: G.facilities_by_level_ordered(B.forecasts(s, b), LEVEL_OVERRIDES),
    # P20 / P21
    "top_products": lambda s, b: R.top_products(B.forecasts(s, b), 5),
    "products_by_category_tn": _products_tn,
    "max_product_per_category_tn": lambda s, b: R.max_product_per_category(_products_tn(s, b)),
    "bottom_products_per_category_tn": lambda s, b: R.bottom_products(_products_tn(s, b), 5),
    "products_report_tn": lambda s, b: R.products_report(_products_tn(s, b)),
    # P22 - P24
    "top_categories": lambda s, b: R.top_categories(B.forecasts(s, b), B.product_classifications(s, b), 10),
    "top_categories_by_level": lambda s, b: R.top_categories_by_level(
        B.forecasts(s, b), B.product_classifications(s, b), 10, levels=KEPH_LEVELS
    ),
    "top_categories_by_ven": lambda s, b: R.top_categories_by_ven(
        B.forecasts(s, b), B.product_classifications(s, b), B.new_product_categorization(s, b), 10
    ),
    "top_categories_by_level_table": lambda s, b: R.category_table(
        R.top_categories_by_level(B.forecasts(s, b), B.product_classifications(s, b), 10, levels=KEPH_LEVELS)
    ),
    "top_categories_by_ven_table": lambda s, b: R.category_table(
        R.top_categories_by_ven(
            B.forecasts(s, b), B.product_classifications(s, b), B.new_product_categorization(s, b), 10
        )
    ),
    # P25
    "clean_categorisation": lambda s, b: C.clean_categorisation(
        B.old_product_categorization(s, b), B.new_product_categorization(s, b)
    ),
    # P26 - P29
    "workload_extract": lambda s, b: W.workload_extract(
        B.analytics(s, b), WORKLOAD_PERIOD, WORKLOAD_ELEMENTS, WORKLOAD_OWNERSHIPS, WORKLOAD_LEVELS
    ),
    "workload_extract_one_county": lambda s, b: W.workload_extract(
        B.analytics(s, b), WORKLOAD_PERIOD, WORKLOAD_ELEMENTS, SOME_OWNERSHIPS, SOME_LEVELS,
        facilities=select_county(B.organisation_units(s, b).withColumnRenamed("county_name", "county"), ONE_COUNTY),
    ),
    "workload_aggregate": _workload_agg,
    "workload_aggregate_landed": _workload_landed,
    "workload_enrich": _workload_enriched,
    "workload_report": lambda s, b: W.workload_report(_workload_enriched(s, b)),
    # P30 - P37
    "ven_gaps": lambda s, b: C.ven_gaps(B.forecasts(s, b)),
    "classification_coverage_items": lambda s, b: C.classification_coverage(
        B.forecasts(s, b), B.product_classifications(s, b)
    ),
    "classification_coverage_first": lambda s, b: C.classification_coverage(
        B.forecasts(s, b), B.product_classifications(s, b), first_row=True
    ),
    "classification_coverage_one_county": lambda s, b: C.classification_coverage(
        B.forecasts(s, b), B.product_classifications(s, b), first_row=True, county=ONE_COUNTY
    ),
    "rmnch_catalogue": lambda s, b: C.rmnch_catalogue(B.product_classifications(s, b), B.rmnch_products(s, b)),
    "facility_counts_hierarchy": lambda s, b: G.facility_counts(_hierarchy(s, b)),
    "facility_counts_forecasts": lambda s, b: G.facility_counts(B.forecasts(s, b)),
    "facility_search": lambda s, b: G.facility_search(_hierarchy(s, b), SEARCH_PATTERN, sub_county=SEARCH_SUB_COUNTY),
    "county_grand_total": lambda s, b: R.county_grand_total(B.forecasts(s, b)),
    "distinct_org_units": lambda s, b: G.distinct_org_units(B.forecasts(s, b)),
    "unclassified_rows": lambda s, b: C.unclassified_rows(B.forecasts(s, b), B.product_classifications(s, b)),
    # source order
    "source_ordered_items": lambda s, b: U.source_ordered_items(B.forecasts_tn(s, b)),
    "item_run_ids": lambda s, b: U.item_run_ids(B.forecasts_tn(s, b)).select(
        "sub_county", "source_row", "item_description_name_form_strength", "id"
    ),
}


def _wrap(fn: Query) -> Query:
    def run(spark: SparkSession, base: str) -> DataFrame:
        clear_plans(spark)
        return edge(fn(spark, base))

    run.__doc__ = fn.__doc__
    return run


QUERIES: dict[str, Query] = {k: _wrap(v) for k, v in _RAW.items()}
