"""Facility workload: landed analytics extract -> aggregate -> enrich.

The reference downloads the extract over HTTP; here it is landed CSV
files (``landed_extract``: header names snake-cased, then typed by the
declared schema) or any table of that schema, and the request parameters
become predicates that reach the scan.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType, StructField, StructType

from quantis.operators.columns import clean_names, drop_range
from quantis.operators.joins import null_safe_join, semi_join
from quantis.schemas import ANALYTICS
from quantis.sources.readers import csv_headers

WORKLOAD_KEYS = ("organisation_unit", "facility_ownership", "keph_level")

WORKLOAD_SUM = "decimal(28,10)"

# The ownership whose rows the report keeps.
KEPT_OWNERSHIP = "Ministry of Health"


def workload_extract(
    analytics: DataFrame,
    period: str,
    data_elements: Sequence[str],
    ownerships: Sequence[str],
    levels: Sequence[str],
    facilities: DataFrame | None = None,
) -> DataFrame:
    """The request's selection: one period, listed data elements,
    ownerships and KEPH levels, and optionally only the facilities of one
    county (``facilities`` with a ``facility_id`` column, semi-joined)."""
    a = analytics.where(
        (F.col("period") == period)
        & F.col("data").isin(*data_elements)
        & F.col("facility_ownership").isin(*ownerships)
        & F.col("keph_level").isin(*levels)
    )
    if facilities is not None:
        a = semi_join(a, facilities, ("organisation_unit", "facility_id"))
    return a


def landed_extract(spark: SparkSession, path: str) -> DataFrame:
    """The analytics CSV files as landed from the API, whatever the order and
    spelling of each file's columns.

    Files are grouped by their header line; each group is read as text with
    its own header, its names are cleaned to snake case (``clean_names``), and
    the declared columns are taken by name and typed, so that the groups meet
    in one schema.  There are as many groups as different headers.

    Nothing is lost silently: a row with too few or too many fields fails the
    read (``FAILFAST``), a text that is no number fails its cast, and a file
    without a declared column raises here, as does one with a repeated name
    and a folder without any header."""
    groups = csv_headers(spark, path)
    if not groups:
        raise ValueError(f"{path}: no file with a header")
    return reduce(DataFrame.unionByName, [_landed_group(spark, header, files) for header, files in sorted(groups.items())])


def _landed_group(spark: SparkSession, header: tuple[str, ...], files: list[str]) -> DataFrame:
    """Files of one header, typed by the declared schema."""
    if len(set(header)) < len(header):
        raise ValueError(f"{files[0]}: repeated column in {', '.join(header)}")
    schema = StructType([StructField(name, StringType()) for name in header])
    # with all columns read, every row is checked against the header's width
    landed = spark.read.option("columnPruning", False).csv(files, header=True, schema=schema, mode="FAILFAST", enforceSchema=False)
    named = clean_names(landed)
    absent = [f.name for f in ANALYTICS.fields if f.name not in named.columns]
    if absent:
        raise ValueError(f"{files[0]}: no column {', '.join(absent)}")

    def typed(name: str, kind: DataType) -> Column:
        text = F.col(name)
        if kind == StringType():
            return text
        number = text.try_cast(kind)
        bad = text.isNotNull() & (F.trim(text) != "") & number.isNull()
        return F.when(bad, F.raise_error(F.concat(F.lit(f"{name} is no number: "), text)).cast(kind)).otherwise(number)

    return named.select(*[typed(f.name, f.dataType).alias(f.name) for f in ANALYTICS.fields])


def workload_aggregate(extract: DataFrame) -> DataFrame:
    """Drop numerator..divisor, sum value per (org unit, ownership,
    level), 0 for an all-missing group.  Workload values are no money: they
    are summed with ten decimals, so that small ones count, and the order of
    partial sums does not show."""
    d = drop_range(extract, "numerator", "divisor")
    total = F.sum(F.col("value").cast(WORKLOAD_SUM))
    return d.groupBy(*WORKLOAD_KEYS).agg(F.coalesce(total, F.lit(0).cast(WORKLOAD_SUM)).cast("double").alias("value"))


def workload_enrich(
    agg: DataFrame, organisation_units: DataFrame, keph_levels: DataFrame, ownerships: DataFrame
) -> DataFrame:
    """Every aggregated row keeps its place (left join from the fact
    side to the org units -- the reference's right join), unknown levels and
    ownerships drop out (inner joins to the two code lists), then the report
    projection and the Ministry-of-Health filter."""
    o = organisation_units.select(
        "facility_id", "facility_name", "ward_name", "sub_county_name", "county_name", "mfl_code"
    )
    j = null_safe_join(agg, o.withColumnRenamed("facility_id", "__fid"), ("organisation_unit", "__fid"), "left")
    j = null_safe_join(j, keph_levels, ("keph_level", "keph_level_id"), "inner")
    own = ownerships.select("facility_ownership_id", "facility_ownership_short")
    j = null_safe_join(j, own, ("facility_ownership", "facility_ownership_id"), "inner")
    out = j.select(
        F.col("keph_level_name").alias("keph_level"),
        F.col("county_name").alias("county"),
        F.col("sub_county_name").alias("sub_county"),
        F.col("ward_name").alias("ward"),
        "facility_name",
        F.col("organisation_unit").alias("facility_id"),
        F.col("sub_county_name").alias("sub_county_2"),
        "mfl_code",
        F.col("facility_ownership_short").alias("facility_ownership"),
        F.col("value").alias("total_workload"),
    )
    return out.where(F.col("facility_ownership") == KEPT_OWNERSHIP)


def workload_report(enriched: DataFrame) -> DataFrame:
    """The six columns handed over for facility classification."""
    return enriched.select(
        "keph_level", "sub_county", "facility_name", F.col("total_workload").alias("workload"), "mfl_code",
        "facility_ownership",
    )
