"""Org-unit hierarchy, ward assignment and facility checks.

The org-unit tree is an adjacency list ``(id, name, parent_id)`` of fixed
depth (country -> county -> sub-county -> ward -> facility), so flattening
it is two chained self equi-joins -- no graph engine and no collected id
lists (the reference's nested ``%in% pull(id)`` filters are implied by the
inner joins).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quantis.functions.text import (
    SUB_COUNTY_SUFFIX,
    WARD_SUFFIX,
    clean_tab,
    detect,
    remove_all,
    strip_org_suffix,
    title_case,
)
from quantis.functions.values import money_total
from quantis.operators.crosstab import crosstab
from quantis.operators.joins import anti_join, null_safe_join
from quantis.operators.numbering import number_rows
from quantis.operators.trees import descend
from quantis.plans.common import county_funded, recomputed_value, select_county
from quantis.schemas import NEW_PRICE, VALUE


def resolve_county_id(org_units: DataFrame, root_id: str, county: str | None = None) -> DataFrame:
    """``(county_id, county)`` of the counties directly under
    ``root_id``; the name loses its first `` County``/`` Sub County`` and is
    trimmed.  With ``county`` only the unit whose plain name equals the
    title-cased parameter is returned (zero or one row expected)."""
    o = org_units.where(F.col("parent_id") == root_id).select(
        F.col("id").alias("county_id"), strip_org_suffix("name").alias("county")
    )
    if county is not None:
        o = o.where(F.col("county") == title_case(F.lit(county)))
    return o


def org_unit_paths(org_units: DataFrame) -> DataFrame:
    """Every org unit with its ``depth`` below its root and the ``/``-joined
    ids (``path``) and plain names (``names``) from the root down to it, for
    trees of any depth.  Units whose parent is not in the list are roots, as
    those without a parent; units in or below a cycle raise."""
    o = org_units.select("id", "parent_id", strip_org_suffix("name").alias("name"))
    tree = descend(o, "id", "parent_id", {"path": "id", "names": "name"})
    return tree.select("id", "name", "depth", F.array_join("path", "/").alias("path"), F.array_join("names", "/", "").alias("names"))


def flatten_hierarchy(org_units: DataFrame, counties: DataFrame) -> DataFrame:
    """``(county, sub_county, ward, facility_name)`` for every facility
    three levels below the given counties (``counties`` from
    :func:`resolve_county_id`); every `` Ward`` / `` Sub County`` is removed
    from the names; distinct rows."""
    ou = org_units.select("id", "name", "parent_id")
    subs = ou.join(counties, ou.parent_id == counties.county_id).select(
        F.col("id").alias("sub_id"), F.col("name").alias("sub_name"), "county"
    )
    wards = ou.join(subs, ou.parent_id == subs.sub_id).select(
        F.col("id").alias("ward_id"), F.col("name").alias("ward_name"), "sub_name", "county"
    )
    facs = ou.join(wards, ou.parent_id == wards.ward_id)
    return facs.select(
        "county",
        remove_all("sub_name", SUB_COUNTY_SUFFIX).alias("sub_county"),
        remove_all("ward_name", WARD_SUFFIX).alias("ward"),
        F.col("name").alias("facility_name"),
    ).distinct()


def _override_table(overrides: DataFrame | Mapping[str, str], spark) -> DataFrame:
    """One ward per facility name.  A table has no first row, so a name with
    two different wards is an error of the list and fails the query."""
    if isinstance(overrides, DataFrame):
        o = overrides
    else:
        o = spark.createDataFrame(list(overrides.items()), "facility_name string, ward string")
    ward = F.min("ward")
    two = F.raise_error(F.concat(F.lit("two override wards for "), F.first("facility_name")))
    return o.groupBy("facility_name").agg(F.when(ward == F.max("ward"), ward).when(F.max("ward").isNotNull(), two).alias("override_ward"))


def assign_ward(
    forecasts: DataFrame,
    hierarchy: DataFrame,
    overrides: DataFrame | Mapping[str, str] | None = None,
) -> DataFrame:
    """Ward of every forecast row: left join to the hierarchy on
    (county, sub_county, facility_name), then a per-facility override wins
    over the joined ward.  Rows with neither keep a NULL ward.

    Both lookups are facility-level (bounded by the facility registry, not
    by the forecasts); AQE broadcasts them if their bytes allow."""
    h = hierarchy.select("county", "sub_county", "facility_name", "ward")
    j = null_safe_join(forecasts, h, ["county", "sub_county", "facility_name"], "left")
    if overrides is None:
        return j
    o = _override_table(overrides, forecasts.sparkSession).withColumn("__o", F.lit(True))
    j = null_safe_join(j, o, "facility_name", "left")
    return j.withColumn("ward", F.when(F.col("__o").isNotNull(), F.col("override_ward")).otherwise(F.col("ward"))).drop(
        "override_ward", "__o"
    )


FACILITY_KEY = ("county", "sub_county", "facility_name")


def requirements_by_ward(
    forecasts: DataFrame,
    hierarchy: DataFrame,
    overrides: DataFrame | Mapping[str, str] | None = None,
    value: str = "stored",
    totals: bool = False,
    tabs: Sequence[str] | None = None,
) -> DataFrame:
    """(sub_county, ward) x clean tab County value, 0-filled, per county.

    ``value``: ``stored`` uses the stored 12-month value, ``recomputed``
    quantity x price, ``new_price`` quantity x new price (divergent county).
    ``totals`` adds the total row and column.  ``tabs`` are the clean tab
    labels in column order (others are summed into ``Other``); ``None``
    discovers them with a job.

    The ward is a function of the facility key, so the facts are first
    aggregated per (facility, tab) -- map-side partial aggregation, one
    small shuffle -- and only that aggregate meets the hierarchy and the
    overrides.  Sums are the same as assigning every row (a facility that
    appears under two wards contributes to both, as a row-level join would).
    """
    f = county_funded(forecasts)
    if value == "recomputed":
        f = f.withColumn(VALUE, recomputed_value())
    elif value == "new_price":
        f = f.withColumn(VALUE, recomputed_value(NEW_PRICE))
    elif value != "stored":
        raise ValueError("value must be 'stored', 'recomputed' or 'new_price'")
    # labels are cleaned on the aggregate (once per facility and tab, not
    # per fact row); the pivot sums tabs that clean to the same label
    per_facility = (
        f.groupBy(*FACILITY_KEY, "tab").agg(money_total(VALUE).alias(VALUE)).withColumn("tab", clean_tab("tab"))
    )
    assigned = assign_ward(per_facility, hierarchy, overrides)
    return crosstab(
        assigned, ["sub_county", "ward"], "tab", VALUE, tabs, by=["county"], fill=True,
        row_total=totals, col_total=totals,
    )


def unmatched_facilities(forecasts: DataFrame, org_units: DataFrame) -> DataFrame:
    """(county, sub_county, facility_name) of forecasts whose facility
    name is not an org-unit name."""
    d = forecasts.select("county", "sub_county", "facility_name").distinct()
    return anti_join(d, org_units.select("name").distinct(), ("facility_name", "name"))


def facilities_without_ward(
    forecasts: DataFrame, hierarchy: DataFrame, overrides: DataFrame | Mapping[str, str] | None = None
) -> DataFrame:
    """Facilities still without a ward after join and overrides.  The
    distinct facilities are taken first, so only they meet the lookups."""
    d = forecasts.select(*FACILITY_KEY).distinct()
    return assign_ward(d, hierarchy, overrides).where(F.col("ward").isNull()).select(*FACILITY_KEY)


def with_level_overrides(df: DataFrame, level_overrides: Mapping[str, str] | None) -> DataFrame:
    """Facilities whose name matches a pattern get that pattern's level."""
    if not level_overrides:
        return df
    expr = None
    for pat, lvl in level_overrides.items():
        cond = detect("facility_name", pat)
        expr = F.when(cond, lvl) if expr is None else expr.when(cond, lvl)
    return df.withColumn("keph_level", expr.otherwise(F.col("keph_level")))


def facilities_by_level(forecasts: DataFrame, level_overrides: Mapping[str, str] | None = None) -> DataFrame:
    """Distinct (county, sub_county, keph_level, facility_name); a
    facility whose name matches an override pattern gets that level.  The
    override is applied after the distinct, as in the reference, so no
    second dedupe."""
    d = forecasts.select("county", "sub_county", "keph_level", "facility_name").distinct()
    return with_level_overrides(d, level_overrides)


def facilities_by_level_ordered(forecasts: DataFrame, level_overrides: Mapping[str, str] | None = None) -> DataFrame:
    """P19 with each row's ``position`` in its county's sheet: the sub-county
    tables one after the other by name, each by its stored level, facilities
    of a level by name."""
    d = forecasts.select("county", "sub_county", "keph_level", "facility_name").distinct()
    numbered = number_rows(d, ["sub_county", "keph_level", "facility_name"], by=["county"], out="position")
    return with_level_overrides(numbered, level_overrides)


def facility_counts(df: DataFrame, by: tuple[str, ...] = ("county", "facility_name")) -> DataFrame:
    """Rows per facility (duplicate-name check)."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))


def facility_search(df: DataFrame, pattern: str, column: str = "facility_name", **equals: str) -> DataFrame:
    """Rows whose ``column`` matches a regex, or whose named columns
    equal the given values (``|``-combined, as in the notebook lookups)."""
    cond = detect(column, pattern)
    for c, v in equals.items():
        cond = cond | (F.col(c) == v)
    return df.where(cond)


def distinct_org_units(forecasts: DataFrame, county: str | None = None) -> DataFrame:
    """Distinct (county, sub_county, facility_name)."""
    return select_county(forecasts, county).select("county", "sub_county", "facility_name").distinct()
