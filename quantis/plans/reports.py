"""County reports: summaries, VEN totals, RMNCH shares, top-k reports."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quantis.functions.text import clean_tab
from quantis.functions.values import money_total, pct_label, round_half_even, safe_share, sum_money, thousands
from quantis.operators.columns import format_numbers
from quantis.operators.crosstab import OTHER_VALUES, crosstab
from quantis.operators.ranking import first_n_per_group, max_per_group, top_n
from quantis.plans.classify import VEN_VALUES, classify, resolve_ven
from quantis.plans.common import county_funded, recomputed_value, select_county, sum_by, tn_value
from quantis.schemas import ITEM, VALUE

# RMNCH flags, and the flag given to unclassified products.
RMNCH_FLAGS = ("Yes", "No")
RMNCH_DEFAULT = "No"


def county_summary(unified: DataFrame) -> DataFrame:
    """County-funded value per county of the harmonised forecasts
    (``plans.unify.union_harmonised``); no classification is needed."""
    return county_funded(unified).groupBy("county").agg(sum_money(VALUE).alias(VALUE))


def county_summary_of(sources: Sequence[DataFrame]) -> DataFrame:
    """P3 over several sources of their own schemas, each harmonised
    (``plans.unify.harmonise``, ``harmonise_tn``): every source is summed to
    one row for each of its counties before the union, so the sources meet as
    sums and only these are shuffled again."""
    sums = [county_funded(s).groupBy("county").agg(money_total(VALUE).alias(VALUE)) for s in sources]
    return reduce(DataFrame.unionByName, sums).groupBy("county").agg(sum_money(VALUE).alias(VALUE))


def county_grand_total(forecasts: DataFrame, county: str | None = None) -> DataFrame:
    """Recomputed quantity x price total of County funding, per
    county (the reconciliation figure for every crosstab's total cell)."""
    f = county_funded(select_county(forecasts, county))
    return f.groupBy("county").agg(sum_money(recomputed_value()).alias(VALUE))


def ven_totals(df: DataFrame) -> DataFrame:
    """P10: County value per VEN (long form) with a ``Total`` row per
    county; a NULL VEN stays its own row, apart from the total."""
    long = county_funded(df).groupBy("county", "ven").agg(money_total(VALUE).alias("__v"))
    g = long.groupingSets([["county", "ven"], ["county"]], "county", "ven").agg(
        F.coalesce(F.sum("__v"), F.lit(0).cast("decimal(38,4)")).alias("__v"), F.grouping("ven").alias("__g")
    )
    label = F.when(F.col("__g") == 1, F.lit("Total")).otherwise(F.col("ven"))
    v = F.col("__v").cast("double")
    return g.select("county", label.alias("ven"), v.alias(VALUE), v.alias("Total"))


def ven_totals_resolved(forecasts: DataFrame, new_cat: DataFrame, how: str = "inner") -> DataFrame:
    """P10 after VEN resolution (P7): the facts are summed per (county, tab,
    item, VEN) first, so only that aggregate meets the new categorisation."""
    f = sum_by(county_funded(forecasts), ["county", "tab", ITEM, "ven", "funding"])
    return ven_totals(resolve_ven(f, new_cat, how))


def rmnch_long(forecasts: DataFrame, classes: DataFrame, county: str | None = None) -> DataFrame:
    """County value per (county, clean tab, RMNCH flag); a missing flag is
    ``No``.  Exact decimal sums."""
    f = sum_by(county_funded(select_county(forecasts, county)), ["county", "tab", ITEM])
    j = classify(f, classes, ("rmnch_product",))
    j = j.withColumn("rmnch_product", F.coalesce(F.col("rmnch_product"), F.lit(RMNCH_DEFAULT))).withColumn(
        "tab", clean_tab("tab")
    )
    return j.groupBy("county", "tab", "rmnch_product").agg(money_total(VALUE).alias("metric"))


def rmnch_share(forecasts: DataFrame, classes: DataFrame, county: str | None = None) -> DataFrame:
    """Share of RMNCH Yes/No within each tab, rounded to 2 (ties to
    even), wide, ``% of RMNCH`` from the rounded shares, totals.

    Deviation: a tab whose value is 0 gives NULL shares, not NaN."""
    long = rmnch_long(forecasts, classes, county)
    share = round_half_even(safe_share("metric", F.sum("metric").over(Window.partitionBy("county", "tab"))), 2)
    long = long.withColumn("share", share.cast("decimal(12,2)"))
    wide = crosstab(
        long, ["tab"], "rmnch_product", "share", RMNCH_FLAGS, by=["county"], pre_aggregated=True,
        row_total=True, col_total=True, total_flag="__t",
    )
    pct = F.when(F.col("__t"), F.lit("-")).otherwise(pct_label(safe_share("Yes", F.col("Yes") + F.col("No"))))
    return wide.select("county", "tab", "Yes", "No", OTHER_VALUES, pct.alias("% of RMNCH"), "Total")


def rmnch_value_pct(forecasts: DataFrame, classes: DataFrame, county: str | None = None) -> DataFrame:
    """RMNCH Yes / No values per tab, Total, the Yes percentage of the
    row and of the county's grand total, and a total row (its two
    percentage cells are ``-``)."""
    long = rmnch_long(forecasts, classes, county)
    wide = crosstab(
        long, ["tab"], "rmnch_product", "metric", RMNCH_FLAGS, by=["county"], pre_aggregated=True,
        row_total=True, col_total=True, total_flag="__t",
    )
    grand = F.max(F.when(F.col("__t"), F.col("Total"))).over(Window.partitionBy("county"))
    pct_row = F.when(F.col("__t"), F.lit("-")).otherwise(pct_label(safe_share("Yes", F.col("Yes") + F.col("No"))))
    pct_tot = F.when(F.col("__t"), F.lit("-")).otherwise(pct_label(safe_share("Yes", grand)))
    return wide.select(
        "county",
        "tab",
        F.col("Yes").alias("RMNCH_Yes"),
        F.col("No").alias("RMNCH_No"),
        F.col(OTHER_VALUES).alias("RMNCH_Other"),
        "Total",
        pct_row.alias("% of RMNCH_Yes"),
        pct_tot.alias("% of RMNCH_Yes_total"),
    )


def rmnch_summary(forecasts: DataFrame, classes: DataFrame, county: str | None = None) -> DataFrame:
    """One row per county: RMNCH Yes value, No value, the value under
    any other flag, total."""
    long = rmnch_long(forecasts, classes, county)
    zero = F.lit(0).cast("decimal(38,4)")
    yes = F.coalesce(F.sum(F.when(F.col("rmnch_product") == "Yes", F.col("metric"))), zero)
    no = F.coalesce(F.sum(F.when(F.col("rmnch_product") == "No", F.col("metric"))), zero)
    rest = F.coalesce(F.sum(F.when(~F.col("rmnch_product").isin(*RMNCH_FLAGS), F.col("metric"))), zero)
    total = F.coalesce(F.sum("metric"), zero)
    return long.groupBy("county").agg(yes.alias("y"), no.alias("n"), rest.alias("o"), total.alias("t")).select(
        "county",
        F.col("y").cast("double").alias("metric_yes"),
        F.col("n").cast("double").alias("metric_no"),
        F.col("o").cast("double").alias("metric_other"),
        F.col("t").cast("double").alias("total"),
    )


def top_products(forecasts: DataFrame, n: int = 5, county: str | None = None, funding: str | None = None) -> DataFrame:
    """P20: top ``n`` items per cleaned tab by value, ties kept.  The
    reference applies no funding filter here; ``funding`` adds one."""
    f = select_county(forecasts, county)
    if funding is not None:
        f = f.where(F.col("funding") == funding)
    agg = f.groupBy("county", "tab", ITEM).agg(sum_money(VALUE).alias(VALUE)).withColumn("tab", clean_tab("tab"))
    return top_n(agg, VALUE, n, ["county", "tab"], ties=True)


def products_by_category_tn(forecasts_tn: DataFrame) -> DataFrame:
    """County value per (tab, item) of the divergent county, value
    recomputed from the new price."""
    f = county_funded(forecasts_tn).withColumn(VALUE, tn_value())
    return (
        f.groupBy("county", "tab", ITEM)
        .agg(sum_money(VALUE).alias(VALUE))
        .withColumn("tab", clean_tab("tab"))
    )


def max_product_per_category(products: DataFrame) -> DataFrame:
    """P21 tail: the item(s) with the largest value in each tab."""
    return max_per_group(products, VALUE, ["county", "tab"])


def bottom_products(products: DataFrame, n: int = 5) -> DataFrame:
    """P21 tail: the ``n`` smallest items per tab, ties kept."""
    return top_n(products, VALUE, n, ["county", "tab"], ties=True, smallest=True)


def products_report(products: DataFrame) -> DataFrame:
    """P21 presentation: items by descending value within each county, a
    total row per county last, thousands separators (whole numbers, ``,``
    as separator).  Values become text here, so this is for sinks only."""
    tot = products.groupBy("county").agg(
        F.lit("Total").alias("tab"), F.lit("-").alias(ITEM), money_total(VALUE).cast("double").alias(VALUE)
    )
    both = products.select("county", "tab", ITEM, VALUE, F.lit(0).alias("__t")).unionByName(tot.withColumn("__t", F.lit(1)))
    ordered = both.orderBy("county", "__t", F.col(VALUE).desc_nulls_last(), "tab", ITEM)
    return ordered.select("county", "tab", ITEM, thousands(VALUE, 0).alias(VALUE))


def _classified(forecasts: DataFrame, classes: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """County value per (county, tab, item, *extra), pre-aggregated, then
    the product classification joined on (item, tab)."""
    f = sum_by(county_funded(forecasts), ["county", "tab", ITEM, *extra])
    return classify(f, classes, ("product_classification",))


def top_categories(forecasts: DataFrame, classes: DataFrame, n: int = 10, county: str | None = None) -> DataFrame:
    """Top ``n`` product classifications by County value per county,
    unclassified dropped, exactly ``n`` (name breaks ties)."""
    agg = (
        _classified(select_county(forecasts, county), classes)
        .groupBy("county", "product_classification")
        .agg(sum_money(VALUE).alias(VALUE))
        .where(F.col("product_classification").isNotNull())
    )
    order = [F.col(VALUE).desc_nulls_last(), F.col("product_classification").asc_nulls_last()]
    return first_n_per_group(agg, n, ["county"], order)


def top_categories_by_level(
    forecasts: DataFrame, classes: DataFrame, n: int = 10, county: str | None = None, levels: Sequence[str] | None = None
) -> DataFrame:
    """Classification x KEPH level (absent cells stay NULL), Total
    column, top ``n`` by Total per county."""
    j = _classified(select_county(forecasts, county), classes, ("keph_level",))
    j = j.where(F.col("product_classification").isNotNull())
    wide = crosstab(j, ["product_classification"], "keph_level", VALUE, levels, by=["county"], fill=False, col_total=True)
    order = [F.col("Total").desc_nulls_last(), F.col("product_classification").asc_nulls_last()]
    return first_n_per_group(wide, n, ["county"], order)


def top_categories_by_ven(
    forecasts: DataFrame, classes: DataFrame, new_cat: DataFrame, n: int = 10, county: str | None = None
) -> DataFrame:
    """VEN resolved (left), classification x VEN (0-filled, V first),
    Total column, top ``n`` by Total per county."""
    f = sum_by(county_funded(select_county(forecasts, county)), ["county", "tab", ITEM, "ven"])
    r = resolve_ven(f, new_cat, "left")
    j = classify(r, classes, ("product_classification",)).where(F.col("product_classification").isNotNull())
    wide = crosstab(j, ["product_classification"], "ven", VALUE, VEN_VALUES, by=["county"], fill=True, col_total=True)
    order = [F.col("Total").desc_nulls_last(), F.col("product_classification").asc_nulls_last()]
    return first_n_per_group(wide, n, ["county"], order)


# Header of the class column in the published top-10 tables.
CATEGORY_HEADER = "Product Category"


def category_table(top: DataFrame) -> DataFrame:
    """P23/P24 as published: the class column headed ``Product Category``
    and every value as a whole number with thousands separators."""
    named = top.withColumnRenamed("product_classification", CATEGORY_HEADER)
    return format_numbers(named, 0)


def product_report_pack(
    forecasts: DataFrame, classes: DataFrame, new_cat: DataFrame, county: str | None = None, materialize: bool = True,
    levels: Sequence[str] | None = None,
) -> dict[str, DataFrame]:
    """Every product report of a county pack from one pass over the facts.

    The forecasts are summed once into the shared report cube
    (``plans.unify.report_cube``; checkpointed to the cluster's checkpoint
    directory when ``materialize``), and each report is computed from the
    cube, with results identical to running it on the forecasts."""
    from quantis.plans.classify import by_product_or_equipment, by_ven
    from quantis.plans.unify import report_cube

    cube = report_cube(select_county(forecasts, county), materialize=materialize)
    return {
        "by_product_or_equipment": by_product_or_equipment(cube, classes),
        "by_ven": by_ven(cube, new_cat),
        "ven_totals": ven_totals(cube),
        "ven_totals_resolved": ven_totals_resolved(cube, new_cat),
        "rmnch_share": rmnch_share(cube, classes),
        "rmnch_value_pct": rmnch_value_pct(cube, classes),
        "rmnch_summary": rmnch_summary(cube, classes),
        "top_products": top_products(cube, 5),
        "top_categories": top_categories(cube, classes),
        "top_categories_by_level": top_categories_by_level(cube, classes, levels=levels),
        "top_categories_by_ven": top_categories_by_ven(cube, classes, new_cat),
    }
