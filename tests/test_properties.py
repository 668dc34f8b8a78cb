"""
and randomized operator checks against brute force."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quantis.catalog import QUERIES
from quantis.operators import anti_join, crosstab, keep_first, semi_join, top_n
from quantis.plans import classify as C
from quantis.schemas import ITEM, VALUE
from quantis.sources import binding as B
from tests.conftest import SF_SMALL, rows

CELLS = ["Product", "Equipment", "NA", "Other"]


def test_cells_sum_to_source_and_reconcile_with_grand_total(spark):
    wide = QUERIES["by_product_or_equipment"](spark, SF_SMALL)
    totals = {r[0]: r[1:] for r in rows(wide.where(F.col("tab") == "Total"), "county", *CELLS, "Total")}
    detail = {
        r[0]: r[1:]
        for r in rows(wide.where(F.col("tab") != "Total").groupBy("county").agg(*[F.sum(c) for c in CELLS + ["Total"]]))
    }
    grand = dict(rows(QUERIES["county_grand_total"](spark, SF_SMALL)))
    assert set(totals) == set(grand)
    for county, t in totals.items():
        assert t == pytest.approx(detail[county], rel=1e-12)
        assert t[-1] == pytest.approx(sum(t[:-1]), rel=1e-12)
        assert t[-1] == pytest.approx(grand[county], rel=1e-12)


def test_resolve_ven_row_laws(spark):
    f = B.forecasts(spark, SF_SMALL)
    nc = B.new_product_categorization(spark, SF_SMALL)
    left = C.resolve_ven(f, nc, "left")
    inner = C.resolve_ven(f, nc, "inner")
    assert left.count() == f.count()  # new_cat is unique on (item, tab)
    assert inner.subtract(left).count() == 0  # inner is a subset of left
    assert f.where(F.col("ven").isNotNull()).subtract(left).count() == 0  # known VENs pass through


def test_rmnch_shares_sum_to_one(spark):
    wide = QUERIES["rmnch_share"](spark, SF_SMALL).where(F.col("tab") != "Total")
    for county, tab, total in rows(wide, "county", "tab", "Total"):
        assert total == pytest.approx(1.0, abs=0.011), (county, tab)


def test_top_products_is_a_top_set(spark):
    from quantis.functions import clean_tab, sum_money

    top = QUERIES["top_products"](spark, SF_SMALL)
    f = B.forecasts(spark, SF_SMALL)
    allv = f.groupBy("county", "tab", ITEM).agg(sum_money(VALUE).alias(VALUE)).withColumn("tab", clean_tab("tab"))
    kept = set(rows(top, "county", "tab", ITEM, VALUE))
    groups: dict = {}
    for r in rows(allv, "county", "tab", ITEM, VALUE):
        groups.setdefault(r[:2], []).append(r)
    assert kept <= {r for g in groups.values() for r in g}
    for key, members in groups.items():
        mine = [r for r in members if r in kept]
        assert len(mine) >= min(5, len(members))
        low = min(r[3] for r in mine)
        assert all(r[3] < low for r in members if r not in kept)  # ties at the cut are kept


def test_anti_and_semi_partition_the_input(spark):
    d = B.forecasts(spark, SF_SMALL).select("county", "sub_county", "facility_name").distinct()
    names = B.org_units(spark, SF_SMALL).select("name")
    a = anti_join(d, names, ("facility_name", "name"))
    s = semi_join(d, names, ("facility_name", "name"))
    assert a.count() + s.count() == d.count()
    assert a.intersect(s).count() == 0


SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
small_rows = st.lists(
    st.tuples(st.sampled_from(["a", "b", None]), st.sampled_from(["x", "y", "z", None]),
              st.one_of(st.none(), st.integers(-5, 5).map(float))),
    min_size=1, max_size=25,
)


@SETTINGS
@given(data=small_rows, fill=st.booleans())
def test_crosstab_matches_brute_force(spark, data, fill):
    df = spark.createDataFrame(data, "r string, k string, v double")
    out = {r[0]: r[1:] for r in rows(crosstab(df, ["r"], "k", "v", ["x", "y", "NA"], fill=fill, col_total=True))}
    expect = {}
    for r in {d[0] for d in data}:
        cells = []
        for key in ["x", "y", "NA", "z"]:  # z is not listed: the column of other values
            vs = [d[2] for d in data if d[0] == r and (d[1] if d[1] is not None else "NA") == key]
            cells.append(sum(v for v in vs if v is not None) if vs else (0.0 if fill else None))
        expect[r] = tuple(cells) + (sum(c for c in cells if c is not None),)
    assert out == expect


@SETTINGS
@given(data=small_rows, n=st.integers(1, 4), smallest=st.booleans())
def test_top_n_matches_brute_force(spark, data, n, smallest):
    df = spark.createDataFrame([(g, i, v) for i, (g, _, v) in enumerate(data)], "g string, i int, v double")
    got = sorted(r[0] for r in rows(top_n(df, "v", n, ["g"], smallest=smallest), "i"))
    expect = []
    for g in {d[0] for d in data}:
        members = [(i, v) for i, (gg, _, v) in enumerate(data) if gg == g]
        key = (lambda v: (v is None, v if v is not None else 0)) if smallest else (lambda v: (v is None, -(v or 0)))
        for i, v in members:
            rank = 1 + sum(1 for _, w in members if key(w) < key(v))
            if rank <= n:
                expect.append(i)
    assert got == sorted(expect)


@SETTINGS
@given(data=small_rows)
def test_keep_first_matches_brute_force(spark, data):
    df = spark.createDataFrame([(g, i, k) for i, (g, k, _) in enumerate(data)], "g string, i int, k string")
    got = sorted(rows(keep_first(df, ["g"], ["i"])), key=str)
    first = {}
    for i, (g, k, _) in enumerate(data):
        first.setdefault(g, (g, i, k))
    assert got == sorted(first.values(), key=str)


def test_one_county_reports_equal_the_all_county_reports(spark):
    from quantis.plans import classify as C
    from quantis.plans import geo as G
    from quantis.plans import reports as R2

    f = B.forecasts(spark, SF_SMALL)
    cls = B.product_classifications(spark, SF_SMALL)
    nc = B.new_product_categorization(spark, SF_SMALL)
    cases = {
        "by_product_or_equipment": lambda c: C.by_product_or_equipment(f, cls, county=c),
        "by_ven": lambda c: C.by_ven(f, nc, county=c),
        "rmnch_share": lambda c: R2.rmnch_share(f, cls, county=c),
        "rmnch_summary": lambda c: R2.rmnch_summary(f, cls, county=c),
        "top_products": lambda c: R2.top_products(f, 5, county=c),
        "top_categories": lambda c: R2.top_categories(f, cls, 10, county=c),
        "top_categories_by_ven": lambda c: R2.top_categories_by_ven(f, cls, nc, 10, county=c),
        "county_grand_total": lambda c: R2.county_grand_total(f, county=c),
        "distinct_org_units": lambda c: G.distinct_org_units(f, county=c),
    }
    for name, rep in cases.items():
        one = sorted(rows(rep(" middle EAST ")), key=str)
        assert one, name
        allc = sorted(rows(rep(None).where(F.col("county") == "Middle East")), key=str)
        assert one == allc, name
