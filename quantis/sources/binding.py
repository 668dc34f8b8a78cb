"""Binding of the driver's TPC-H-style test tables to the forecast domain.

The reference reads forecast tables it never ships; the test tables are
bound to that domain with plain column expressions (each one repeatable in
SQL by the DuckDB oracle).  The fact is

    lineitem -> orders -> customer (facility) -> nation (sub-county)
             -> region (county), and lineitem -> part (item, tab)

and the dimensions are derived from ``part``, ``customer`` and ``events``.
The test tables hold no NULLs, so the binding *derives* the missing VENs,
unclassified items, unmatched facilities and unknown codes that the reports
must handle.  Every source row is kept: a key that must not match is
misspelled, as in the data that the override lists repair, never left out.

Scale: orders meet their customers before they meet lineitem, nation and
region are broadcast (25 and 5 rows by definition), and every other join is
left to the optimizer and AQE: at 100 TB ``orders``, ``customer`` and
``part`` are shuffled, not broadcast.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

from quantis import schemas as S
from quantis.functions.text import title_case
from quantis.functions.values import ven_or_null
from quantis.sources.readers import memo, read_table

# The 14 forecast category tabs, numbered 1-14 in this order.
# Tabs 2, 4, 6, 7 and 10 carry the names the product/equipment defaults key
# on; 13 and 14 exercise the label cleaner's digit quirk.
CATEGORY_NAMES = (
    "Nutrition",
    "Pharmaceuticals",
    "Non-Pharmaceuticals",
    "Laboratory",
    "Renal",
    "Radiology",
    "Dental",
    "Orthopaedics",
    "Ophthalmology",
    "Physiotherapy",
    "Theatre",
    "Maternity",
    "Oncology",
    "Immunisation",
)

# The region bound to the divergent-schema county, and the
# county name its harmonisation forces.
DIVERGENT_REGION = "AFRICA"
DIVERGENT_COUNTY = "Africa"

# Org-unit tree root id, and the workload lookup tables
# (level code, level name) and (ownership code, long name, short name).
ROOT_ID = "KE"
KEPH_LEVEL_ROWS = (
    ("K0", "KEPH Level 2"),
    ("K1", "KEPH Level 3"),
    ("K2", "KEPH Level 4"),
    ("K3", "KEPH Level 5"),
    ("K04", "KEPH Level 6"),  # misspelled: the events say K4
)
OWNERSHIP_ROWS = (
    ("O0", "Ministry of Health (Government)", "Ministry of Health"),
    ("O1", "Private Practice (General)", "Private Practice"),
    ("O2", "Faith Based Organisation", "Faith Based"),
)


def _memoized(fn):
    """Build each bound table's plan once for a query and base directory."""

    @functools.wraps(fn)
    def wrapper(spark: SparkSession, base: str | None = None) -> DataFrame:
        return memo(spark, (fn.__name__, base), lambda: fn(spark, base))

    return wrapper


def misspelt(name: Column, when: Column) -> Column:
    """The name, misspelled for the rows that must not match."""
    return F.when(when, F.concat(name, F.lit("."))).otherwise(name)


def tab_expr(p_size: Column) -> Column:
    n = p_size % 14 + 1
    names = F.array(*[F.lit(x) for x in CATEGORY_NAMES])
    return F.concat(n.cast("string"), F.lit("."), F.element_at(names, n.cast("int")))


def level_number() -> Column:
    return F.col("c_custkey") % 5 + 2


def keph_level(number: Column) -> Column:
    return F.concat(F.lit("KEPH Level "), number.cast("string"))


@_memoized
def _customers(spark: SparkSession, base: str) -> DataFrame:
    """Customer (facility) attributes computed once per customer."""
    c = read_table(spark, base, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    return c.withColumn("keph_level", keph_level(level_number()))


@_memoized
def _geo(spark: SparkSession, base: str) -> DataFrame:
    """nation -> region (25 rows by definition), county title computed on
    the 5 regions instead of on every fact row."""
    n = read_table(spark, base, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = read_table(spark, base, "region").select("r_regionkey", "r_name", title_case("r_name").alias("r_title"))
    return n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey).drop("n_regionkey", "r_regionkey")


@_memoized
def _facilities(spark: SparkSession, base: str) -> DataFrame:
    """customer -> nation -> region: one row per facility."""
    c = _customers(spark, base)
    geo = _geo(spark, base)
    return c.join(F.broadcast(geo), c.c_nationkey == geo.n_nationkey)


@_memoized
def _parts(spark: SparkSession, base: str) -> DataFrame:
    """Part-level attributes (item, tab, ...) computed once per part."""
    p = read_table(spark, base, "part").select("p_partkey", "p_name", "p_type", "p_size", "p_retailprice")
    return p.select(
        "p_partkey",
        "p_retailprice",
        "p_size",
        F.col("p_name").alias(S.ITEM),
        F.col("p_type").alias("sub_category"),
        tab_expr(F.col("p_size")).alias("tab"),
        F.when(F.col("p_size") % 14 + 1 == 4, "Yes").otherwise("No").alias("contains_lab"),
    )


def _fact(spark: SparkSession, base: str, divergent: bool | None) -> DataFrame:
    """Star join of the facts; ``divergent`` selects the counties of one
    schema, None keeps all.

    Orders meet their facility first, as orders are a fraction of the lines:
    lineitem is then dealt by order and by part, and never by customer, and
    the orders of other counties are dropped before they are dealt (nation x
    region, 25 rows, is always broadcast).  Where all counties are
    kept, the lines are dealt with the nation's key alone and get the names
    at the end.  Orders grow with the lines, so that join is a shuffled one
    at every size, without a sort; a task holds its share of the orders.  The
    level's number travels instead of the customer's key.  Customers and parts are broadcast as long as
    they are small, each compared by its own size (a pre-joined dimension
    chain is estimated as the product of its inputs).
    """
    li = read_table(spark, base, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice",
        "l_discount", "l_returnflag", "l_linestatus",
    )
    o = read_table(spark, base, "orders").select("o_orderkey", "o_custkey")
    c = read_table(spark, base, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment", level_number().alias("level"))
    in_tn = F.col("r_name") == F.lit(DIVERGENT_REGION)
    geo = _geo(spark, base)
    if divergent is not None:
        geo = geo.where(in_tn if divergent else ~in_tn)
    p = _parts(spark, base)
    o = o.join(c, o.o_custkey == c.c_custkey).drop("o_custkey", "c_custkey")
    if divergent is not None:
        o = o.join(F.broadcast(geo), o.c_nationkey == geo.n_nationkey)
    f = li.join(o.hint("shuffle_hash"), li.l_orderkey == o.o_orderkey)
    f = f.join(p, f.l_partkey == p.p_partkey)
    if divergent is None:
        f = f.join(F.broadcast(geo), f.c_nationkey == geo.n_nationkey)
    return f.withColumn("keph_level", keph_level(F.col("level")))


def _common(f: DataFrame) -> dict[str, Column]:
    return {
        "sub_county": F.col("n_name"),
        "facility_type": F.col("c_mktsegment"),
        "facility_name": F.col("c_name"),
        "sub_category": F.col("sub_category"),
        "keph_level": F.col("keph_level"),
        "tab": F.col("tab"),
        "funding": F.when(F.col("l_linestatus") == "F", "County").otherwise("Partner"),
        S.ITEM: F.col(S.ITEM),
        "contains_lab": F.col("contains_lab"),
    }


def _m(c: str) -> Column:
    return F.col(c).cast(S.M)


def _fc_columns(f: DataFrame) -> dict[str, Column]:
    cols = _common(f)
    cols.update(
        {
            "county": F.col("r_title"),
            "ven": F.when(F.col("l_returnflag") == "R", "V").when(
                F.col("l_returnflag") == "A", F.when(F.col("l_linenumber") == 1, "e").otherwise("E")
            ),
            "pack_size": F.col("p_size").cast("string"),
            "price_kes": F.col("p_retailprice"),
            S.QTY: F.col("l_quantity"),
            S.VALUE: (_m("l_quantity") * _m("p_retailprice")).cast(S.M),
            S.BUFFER: _m("l_extendedprice"),
            S.PROCURE: (_m("l_extendedprice") * (F.lit(1).cast(S.M) - _m("l_discount"))).cast(S.M),
        }
    )
    return cols


@_memoized
def forecasts(spark: SparkSession, base: str) -> DataFrame:
    """Forecast rows of every county except the divergent one."""
    f = _fact(spark, base, divergent=False)
    cols = _fc_columns(f)
    return f.select(*[cols[c.name].cast(c.dataType).alias(c.name) for c in S.FORECASTS.fields])


def _tn_columns(f: DataFrame) -> dict[str, Column]:
    cols = _common(f)
    cols.update(
        {
            "county": F.col("r_name"),
            "ven": F.when(F.col("l_returnflag") == "R", "V")
            .when(F.col("l_returnflag") == "A", "e")
            .otherwise("N"),
            S.PACK_X: F.col("p_size").cast("string"),
            "price_kes": F.col("p_retailprice"),
            S.NEW_PRICE: F.col("p_retailprice") + F.lit(10.0),
            S.QTY: F.col("l_quantity"),
            S.BUFFER_PACKS: F.col("l_quantity") + F.lit(2.0),
            S.PROCURE_PACKS: F.col("l_quantity") + F.lit(1.0),
            S.VALUE: _m("l_extendedprice"),
            S.BUFFER: _m("l_extendedprice"),
            S.PROCURE: _m("l_extendedprice"),
            "source_row": F.col("l_orderkey") * 8 + F.col("l_linenumber"),
        }
    )
    return cols


@_memoized
def forecasts_tn(spark: SparkSession, base: str) -> DataFrame:
    """The divergent-schema county: raw upper-case county name, unsanitised
    VEN codes (lower-case ``e`` is junk), ``pack_size.x``, a new price and a
    stale stored value that the harmonisation must recompute."""
    f = _fact(spark, base, divergent=True)
    cols = _tn_columns(f)
    return f.select(*[cols[c.name].cast(c.dataType).alias(c.name) for c in S.FORECASTS_TN.fields])


@_memoized
def harmonised(spark: SparkSession, base: str) -> DataFrame:
    """Every county in the common schema from one star join: what
    ``plans.unify.union_harmonised`` makes of the two sources, which in these
    tables are rows of one fact table."""
    f = _fact(spark, base, divergent=None)
    fc, tn = _fc_columns(f), _tn_columns(f)
    here = F.col("r_name") == DIVERGENT_REGION
    fc[S.VALUE] = (fc[S.QTY].cast(S.M) * fc["price_kes"].cast(S.M)).cast(S.M)
    tn |= {
        "county": F.lit(DIVERGENT_COUNTY),
        "ven": ven_or_null(tn["ven"]),
        "pack_size": tn[S.PACK_X],
        "price_kes": tn[S.NEW_PRICE],
        S.VALUE: (tn[S.QTY].cast(S.M) * tn[S.NEW_PRICE].cast(S.M)).cast(S.M),
    }
    return f.select(
        *[F.when(here, tn[c.name].cast(c.dataType)).otherwise(fc[c.name].cast(c.dataType)).alias(c.name) for c in S.FORECASTS.fields]
    )


@_memoized
def _part_keys(spark: SparkSession, base: str) -> DataFrame:
    """One row per (item, tab) key of ``part`` with its smallest part key."""
    p = read_table(spark, base, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
    return p.groupBy(F.col("p_name").alias(S.ITEM), tab_expr(F.col("p_size")).alias("tab")).agg(
        F.min("p_partkey").alias("k"), F.min("p_brand").alias("brand"), F.min("p_type").alias("ptype")
    )


@_memoized
def product_classifications(spark: SparkSession, base: str) -> DataFrame:
    """Classification dimension, unique on (item, tab); items whose smallest
    part key is a multiple of 7 are misspelled, so some facts do not match.
    One class and one flag are outside the report lists."""
    k = _part_keys(spark, base)
    return k.select(
        misspelt(F.col(S.ITEM), F.col("k") % 7 == 0).alias(S.ITEM),
        "tab",
        F.when(F.col("k") % 3 == 0, "Product")
        .when(F.col("k") % 3 == 1, "Equipment")
        .when(F.col("k") % 9 == 2, "Consumable")
        .alias("product_or_equipment"),
        F.when(F.col("k") % 11 != 0, F.col("brand")).alias("product_classification"),
        F.when(F.col("k") % 4 == 0, "Yes")
        .when(F.col("k") % 4 == 1, "No")
        .when(F.col("k") % 8 == 2, "Unknown")
        .alias("rmnch_product"),
        F.col("ptype").alias("moh_647_name"),
    )


@_memoized
def new_product_categorization(spark: SparkSession, base: str) -> DataFrame:
    """New categorisation; items whose smallest part key is a multiple of 4
    are misspelled, and one VEN code is unknown."""
    k = _part_keys(spark, base)
    return k.select(
        misspelt(F.col(S.ITEM), F.col("k") % 4 == 0).alias("item_name"),
        F.col("tab").alias("product_category"),
        F.when(F.col("k") % 3 == 0, "V")
        .when(F.col("k") % 3 == 1, "E")
        .when(F.col("k") % 6 == 2, "X")
        .otherwise("N")
        .alias("ven"),
        F.when(F.col("k") % 5 == 0, "Equipment").otherwise("Product").alias("product_or_equipment"),
    )


@_memoized
def old_product_categorization(spark: SparkSession, base: str) -> DataFrame:
    return product_classifications(spark, base).select(S.ITEM, "tab", "product_or_equipment")


@_memoized
def rmnch_products(spark: SparkSession, base: str) -> DataFrame:
    p = read_table(spark, base, "part").select("p_name")
    return (
        p.where(F.col("p_name").startswith("small ") | F.col("p_name").startswith("red "))
        .select(F.col("p_name").alias("product"))
        .distinct()
    )


def _ward_id() -> Column:
    """Ward id: one ward per (nation, market segment)."""
    return F.concat(F.lit("W"), F.col("c_nationkey").cast("string"), F.lit("-"), F.col("c_mktsegment"))


@_memoized
def org_units(spark: SparkSession, base: str) -> DataFrame:
    """Adjacency list root -> county -> sub-county -> ward -> facility.
    Facilities whose customer key is a multiple of 13 are misspelled."""
    r = read_table(spark, base, "region")
    n = read_table(spark, base, "nation")
    c = read_table(spark, base, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    root = spark.range(1).select(F.lit(ROOT_ID).alias("id"), F.lit("Kenya").alias("name"), F.lit(None).cast("string").alias("parent_id"))
    counties = r.select(
        F.concat(F.lit("R"), F.col("r_regionkey").cast("string")).alias("id"),
        F.concat(title_case("r_name"), F.lit(" County")).alias("name"),
        F.lit(ROOT_ID).alias("parent_id"),
    )
    subs = n.select(
        F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("id"),
        F.concat(F.col("n_name"), F.lit(" Sub County")).alias("name"),
        F.concat(F.lit("R"), F.col("n_regionkey").cast("string")).alias("parent_id"),
    )
    wards = c.select(
        _ward_id().alias("id"),
        F.concat(title_case("c_mktsegment"), F.lit(" Ward")).alias("name"),
        F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias("parent_id"),
    ).distinct()
    facs = c.select(
        F.concat(F.lit("F"), F.col("c_custkey").cast("string")).alias("id"),
        misspelt(F.col("c_name"), F.col("c_custkey") % 13 == 0).alias("name"),
        _ward_id().alias("parent_id"),
    )
    return root.unionByName(counties).unionByName(subs).unionByName(wards).unionByName(facs)


@_memoized
def ward_overrides(spark: SparkSession, base: str) -> DataFrame:
    c = read_table(spark, base, "customer").select("c_custkey", "c_name")
    return c.where(F.col("c_custkey") % 20 == 0).select(
        F.col("c_name").alias("facility_name"), F.lit("Override").alias("ward")
    )


@_memoized
def master(spark: SparkSession, base: str) -> DataFrame:
    """Data-collection master list: one row per facility, all counties."""
    f = _facilities(spark, base)
    return f.select(
        F.col("r_title").alias("county"),
        F.col("n_name").alias("sub_county"),
        F.col("c_name").alias("facility_name"),
        "keph_level",
    )


def _utc_wall_clock(df: DataFrame, c: str) -> Column:
    """The stored wall-clock time, whatever the session time zone: a
    timestamp read as zone-less is used as is; one read as an instant is
    rendered in UTC."""
    if isinstance(df.schema[c].dataType, TimestampNTZType):
        return F.col(c)
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.col(c).cast("timestamp_ntz"))


@_memoized
def analytics(spark: SparkSession, base: str) -> DataFrame:
    """Landed workload extract (one row per event)."""
    e = read_table(spark, base, "events").select("event_id", "ts", "user_id", "event_type", "value")
    return e.select(
        F.col("event_type").alias("data"),
        F.year(_utc_wall_clock(e, "ts")).cast("string").alias("period"),
        F.concat(F.lit("F"), F.col("user_id").cast("string")).alias("organisation_unit"),
        F.concat(F.lit("O"), (F.col("event_id") % 3).cast("string")).alias("facility_ownership"),
        F.concat(F.lit("K"), (F.col("event_id") % 5).cast("string")).alias("keph_level"),
        F.col("value").cast("double").alias("value"),
        F.col("value").cast("double").alias("numerator"),
        F.lit(1.0).alias("denominator"),
        F.lit(1.0).alias("factor"),
        F.lit(1.0).alias("multiplier"),
        F.lit(1.0).alias("divisor"),
    )


@_memoized
def organisation_units(spark: SparkSession, base: str) -> DataFrame:
    """Facility registry; ids whose customer key is a multiple of 13 are
    misspelled, so some workload rows find no facility."""
    f = _facilities(spark, base)
    return f.select(
        misspelt(F.concat(F.lit("F"), F.col("c_custkey").cast("string")), F.col("c_custkey") % 13 == 0).alias("facility_id"),
        F.col("c_name").alias("facility_name"),
        title_case("c_mktsegment").alias("ward_name"),
        F.col("n_name").alias("sub_county_name"),
        F.col("r_title").alias("county_name"),
        (F.col("c_custkey") + 100000).cast("string").alias("mfl_code"),
    )


@_memoized
def keph_levels(spark: SparkSession, base: str | None = None) -> DataFrame:
    return spark.createDataFrame(list(KEPH_LEVEL_ROWS), S.KEPH_LEVELS)


@_memoized
def facility_ownerships(spark: SparkSession, base: str | None = None) -> DataFrame:
    return spark.createDataFrame(list(OWNERSHIP_ROWS), S.FACILITY_OWNERSHIPS)
