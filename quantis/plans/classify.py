"""Classification pipelines: product/equipment and VEN crosstabs, VEN
resolution, the clean categorisation and the classification checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quantis.functions.text import clean_tab
from quantis.functions.values import VEN_CODES, money_total, ven_or_null
from quantis.operators.crosstab import crosstab, crosstab_map
from quantis.operators.joins import null_safe_join, semi_join
from quantis.operators.ranking import keep_first
from quantis.plans.common import county_funded, keys, recomputed_value, select_county, sum_by, tn_value
from quantis.schemas import BUFFER, BUFFER_PACKS, ITEM, NEW_PRICE, PROCURE, PROCURE_PACKS, VALUE

# product/equipment defaults for unclassified rows, by tab.
PRODUCT_DEFAULTS = (
    ("10.Physiotherapy", "Equipment"),
    ("4.Laboratory", "Product"),
    ("7.Dental", "Product"),
    ("2.Pharmaceuticals", "Product"),
    ("6.Radiology", "Product"),
)

# Report columns (the "NA" column collects rows whose key is missing).
POE_VALUES = ("Product", "Equipment", "NA")
VEN_VALUES = ("V", "E", "N", "NA")


def sanitise_ven(df: DataFrame) -> DataFrame:
    """Any VEN outside {V, E, N} becomes NULL."""
    return df.withColumn("ven", ven_or_null("ven"))


def with_product_defaults(df: DataFrame, default: str | None = None) -> DataFrame:
    """Fill a missing ``product_or_equipment``: per-tab defaults, or one
    ``default`` for every missing row (the divergent county's rule)."""
    poe = F.col("product_or_equipment")
    if default is not None:
        return df.withColumn("product_or_equipment", F.coalesce(poe, F.lit(default)))
    expr: Column | None = None
    for tab, val in PRODUCT_DEFAULTS:
        cond = poe.isNull() & (F.col("tab") == tab)
        expr = F.when(cond, val) if expr is None else expr.when(cond, val)
    return df.withColumn("product_or_equipment", expr.otherwise(poe))


def classify(forecasts: DataFrame, classes: DataFrame, attrs: tuple[str, ...] = ("product_or_equipment",)) -> DataFrame:
    """Left join to a product dimension on (item, tab), NULL-safe; only the
    wanted attributes are brought over (no name clashes, narrow shuffle)."""
    return null_safe_join(forecasts, classes.select(ITEM, "tab", *attrs), keys(), "left")


def by_product_or_equipment(
    forecasts: DataFrame, classes: DataFrame, county: str | None = None, totals: bool = True
) -> DataFrame:
    """P5: tab x {Product, Equipment, NA} County-funded value, with a total
    row and a total column, per county."""
    f = sum_by(county_funded(select_county(forecasts, county)), ["county", "tab", ITEM])
    j = with_product_defaults(classify(f, classes)).withColumn("tab", clean_tab("tab"))
    return crosstab(
        j, ["tab"], "product_or_equipment", VALUE, POE_VALUES, by=["county"],
        row_total=totals, col_total=totals,
    )


def tn_measures(df: DataFrame) -> DataFrame:
    """The divergent county's three values, recomputed from the new price."""
    price = F.col(NEW_PRICE).cast("decimal(18,4)")
    return df.withColumns(
        {
            VALUE: tn_value(),
            BUFFER: (F.col(BUFFER_PACKS).cast("decimal(18,4)") * price).cast("decimal(18,4)"),
            PROCURE: (F.col(PROCURE_PACKS).cast("decimal(18,4)") * price).cast("decimal(18,4)"),
        }
    )


def by_product_or_equipment_tn(forecasts_tn: DataFrame, classes: DataFrame) -> DataFrame:
    """Divergent-schema variant: every missing class defaults to
    Product, values recomputed from the new price, no totals."""
    f = sum_by(county_funded(forecasts_tn.withColumn(VALUE, tn_value())), ["county", "tab", ITEM])
    j = with_product_defaults(classify(f, classes), default="Product").withColumn("tab", clean_tab("tab"))
    return crosstab(j, ["tab"], "product_or_equipment", VALUE, ("Product", "Equipment"), by=["county"])


# The three measures of the divergent county, in report order.
TN_MEASURES = (VALUE, BUFFER, PROCURE)


def by_product_or_equipment_tn_measures(forecasts_tn: DataFrame, classes: DataFrame) -> DataFrame:
    """P6 with all three recomputed values: one row per tab and measure."""
    f = county_funded(tn_measures(forecasts_tn)).groupBy("county", "tab", ITEM).agg(
        *[money_total(m).alias(m) for m in TN_MEASURES]
    )
    j = with_product_defaults(classify(f, classes), default="Product").withColumn("tab", clean_tab("tab"))
    long = j.unpivot(["county", "tab", "product_or_equipment"], list(TN_MEASURES), "measure", "amount")
    return crosstab(long, ["tab", "measure"], "product_or_equipment", "amount", ("Product", "Equipment"), by=["county"])


def new_categorization_keys(new_cat: DataFrame) -> DataFrame:
    """New categorisation renamed to the forecast key names."""
    return new_cat.select(
        F.col("item_name").alias(ITEM), F.col("product_category").alias("tab"), F.col("ven").alias("new_ven")
    )


def resolve_ven(forecasts: DataFrame, new_cat: DataFrame, how: str = "left") -> DataFrame:
    """Fill a missing VEN from the new categorisation on (item, tab).

    One pass instead of split / join / union.  Rows that already have a VEN
    pass through unchanged: where the list is too long for a broadcast, they
    are dealt by a hash of their own instead of by (item, tab), so neither
    they nor a frequent item load one task, and a hot key among the rows
    without a VEN is split by AQE.  Rows without one take ``new_ven`` (NULL if
    no match).
    ``how='left'`` keeps unresolved rows, ``how='inner'`` drops rows that
    had no VEN and found no match.  As with the reference, a key repeated in
    ``new_cat`` repeats the rows that join it.
    """
    nc = new_categorization_keys(new_cat).withColumns({"__hit": F.lit(True), "__spread": F.lit(0).cast("long")})
    # rows with a VEN match nothing: their key is their own hash, which is never 0
    own = F.xxhash64(*[F.col(f"`{c}`") for c in forecasts.columns]).bitwiseOR(F.lit(1))
    spread = forecasts.withColumn("__spread", F.when(F.col("ven").isNull(), F.lit(0).cast("long")).otherwise(own))
    # the number comes first, so sorts seldom compare strings
    j = null_safe_join(spread, nc, ["__spread", *keys()], "left").drop("__spread")
    if how == "inner":
        j = j.where(F.col("ven").isNotNull() | F.col("__hit").isNotNull())
    elif how != "left":
        raise ValueError("how must be 'left' or 'inner'")
    return j.withColumn("ven", F.when(F.col("__hit").isNotNull(), F.col("new_ven")).otherwise(F.col("ven"))).drop(
        "new_ven", "__hit"
    )


def by_ven(
    forecasts: DataFrame, new_cat: DataFrame, county: str | None = None, how: str = "left", value: str = "stored"
) -> DataFrame:
    """Tab x VEN County-funded value after VEN resolution (``how``
    'left' or 'inner'), totals.  ``value='recomputed'`` uses quantity x
    price instead of the stored 12-month value (the notebook variant)."""
    f = county_funded(select_county(forecasts, county))
    if value == "recomputed":
        f = f.withColumn(VALUE, recomputed_value())
    elif value != "stored":
        raise ValueError("value must be 'stored' or 'recomputed'")
    r = resolve_ven(sum_by(f, ["county", "tab", ITEM, "ven"]), new_cat, how).withColumn("tab", clean_tab("tab"))
    return crosstab(r, ["tab"], "ven", VALUE, VEN_VALUES, by=["county"], row_total=True, col_total=True)


def by_ven_map(forecasts: DataFrame, new_cat: DataFrame, county: str | None = None, how: str = "left") -> DataFrame:
    """P9 with whatever codes occur: one map from VEN to value per tab, and a
    total row per county (``pivot_wider`` without declared names)."""
    f = county_funded(select_county(forecasts, county))
    r = resolve_ven(sum_by(f, ["county", "tab", ITEM, "ven"]), new_cat, how).withColumn("tab", clean_tab("tab"))
    return crosstab_map(r, ["tab"], "ven", VALUE, by=["county"], row_total=True, total_col="Total")


def by_ven_tn(forecasts_tn: DataFrame, new_cat: DataFrame) -> DataFrame:
    """P9 (divergent county): sanitise, resolve (left), recompute value,
    drop rows still without VEN, no totals."""
    f = sum_by(county_funded(sanitise_ven(forecasts_tn).withColumn(VALUE, tn_value())), ["county", "tab", ITEM, "ven"])
    r = resolve_ven(f, new_cat, "left").where(F.col("ven").isNotNull()).withColumn("tab", clean_tab("tab"))
    return crosstab(r, ["tab"], "ven", VALUE, VEN_CODES, by=["county"])


def clean_categorisation(old_cat: DataFrame, new_cat: DataFrame) -> DataFrame:
    """P25: new-categorisation rows for items left unclassified in the old
    list (item, tab, product_or_equipment), plus the classified old rows."""
    unclassified = old_cat.where(F.col("product_or_equipment").isNull()).select(ITEM)
    classified = old_cat.where(F.col("product_or_equipment").isNotNull())
    nc = new_cat.select(
        F.col("item_name").alias(ITEM), F.col("product_category").alias("tab"), "product_or_equipment"
    )
    picked = semi_join(nc, unclassified, ITEM)
    return picked.unionByName(classified.select(ITEM, "tab", "product_or_equipment"))


def unclassified_rows(forecasts: DataFrame, classes: DataFrame, county: str | None = None) -> DataFrame:
    """County rows whose product/equipment class is still missing after
    the per-tab defaults."""
    f = county_funded(select_county(forecasts, county))
    return with_product_defaults(classify(f, classes)).where(F.col("product_or_equipment").isNull())


def item_ven_first(forecasts: DataFrame) -> DataFrame:
    """One row per item over all tables: distinct (item, tab, ven), then the
    first row per item: its lowest tab, and within it a missing VEN first
    (so an item whose first tab has any VEN gap is reported)."""
    d = forecasts.select(ITEM, "tab", "ven").distinct()
    return keep_first(d, [ITEM], ["tab", "ven"], nulls_first=["ven"])


def ven_gaps(forecasts: DataFrame) -> DataFrame:
    """Items whose kept row has no VEN."""
    return item_ven_first(forecasts).where(F.col("ven").isNull())


def classification_coverage(
    forecasts: DataFrame, classes: DataFrame, first_row: bool = False, county: str | None = None
) -> DataFrame:
    """Forecast items that appear in the classification, joined on the
    item only (one output row per matching classification row).

    ``first_row=False``: the distinct items of the forecasts (all funding),
    with the classification's columns.  ``first_row=True``: the keep-first
    (item, tab, ven) row per item, with the classification's tab renamed
    ``class_tab``."""
    f = select_county(forecasts, county)
    if first_row:
        return null_safe_join(item_ven_first(f), classes.withColumnRenamed("tab", "class_tab"), ITEM, "inner")
    return null_safe_join(f.select(ITEM).distinct(), classes, ITEM, "inner")


def rmnch_catalogue(classes: DataFrame, rmnch_products: DataFrame) -> DataFrame:
    """Classification rows whose item is on the RMNCH list."""
    return semi_join(classes, rmnch_products, (ITEM, "product"))
