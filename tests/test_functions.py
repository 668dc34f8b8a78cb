"""Column builders against hand-checked values (FIXTURES.md section 2)."""

from quantis.functions import (
    clean_tab,
    detect,
    pct_label,
    remove_first,
    round_half_even,
    safe_share,
    strip_org_suffix,
    sum_money,
    title_case,
    ven_or_null,
)
from tests.conftest import rows


def test_clean_tab_reproduces_cleaner_quirks(spark):
    labels = ["10.Physiotherapy", "12.X", "13.X", "22.X", "4.COVID 19", "NoDigits", "11.Theatre", "14.Renal"]
    df = spark.createDataFrame([(x,) for x in labels], "tab string")
    got = [r[0] for r in rows(df.select(clean_tab("tab")))]
    assert got == ["Physiotherapy", "X", "3X", "X", "COVID 9", "NoDigits", "Theatre", "4Renal"]


def test_clean_tab_strict(spark):
    df = spark.createDataFrame([("13.Oncology",), ("4.COVID 19",)], "tab string")
    assert [r[0] for r in rows(df.select(clean_tab("tab", strict=True)))] == ["Oncology", "COVID 19"]


def test_remove_first_keeps_later_matches(spark):
    df = spark.createDataFrame([("a.b.c",), ("X Sub County",), ("Y County County",)], "x string")
    got = rows(df.select(remove_first("x", r"\."), strip_org_suffix("x")))
    assert got == [("ab.c", "a.b.c"), ("X Sub County", "X"), ("Y County County", "Y County")]


def test_title_case_icu(spark):
    df = spark.createDataFrame([("trans nzoia",), ("tharaka-nithi",), ("MIDDLE EAST",)], "x string")
    assert [r[0] for r in rows(df.select(title_case("x")))] == ["Trans Nzoia", "Tharaka-Nithi", "Middle East"]


def test_ven_or_null(spark):
    df = spark.createDataFrame([(v,) for v in ["V", "E", "N", "X", "v", None]], "ven string")
    assert [r[0] for r in rows(df.select(ven_or_null("ven")))] == ["V", "E", "N", None, None, None]


def test_sum_money_is_exact(spark):
    df = spark.createDataFrame([(0.1,), (0.2,), (0.3,)], "x double")
    assert rows(df.agg(sum_money("x")))[0][0] == 0.6


def test_safe_share_zero_is_null_not_error(spark):
    df = spark.createDataFrame([(0.0, 0.0), (1.0, 4.0)], "a double, b double")
    assert [r[0] for r in rows(df.select(safe_share("a", "b")))] == [None, 0.25]


def test_round_half_even(spark):
    df = spark.createDataFrame([(0.125,), (0.135,)], "x double")
    assert [r[0] for r in rows(df.select(round_half_even("x", 2)))] == [0.12, 0.14]


def test_pct_label(spark):
    df = spark.createDataFrame([(0.5,), (0.33333,), (0.665,), (None,)], "r double")
    assert [r[0] for r in rows(df.select(pct_label("r")))] == ["50%", "33.33%", "66.5%", None]


def test_regex_predicates_are_case_sensitive(spark):
    df = spark.createDataFrame([("lurambi_kakamega",), ("Kakamega",), ("Merti Sub County Hospital",)], "x string")
    assert [r[0] for r in rows(df.select(detect("x", "Merti Sub")))] == [False, False, True]


def test_select_county_is_case_insensitive(spark):
    from quantis.plans.common import select_county

    df = spark.createDataFrame([("Middle East",), ("Asia",)], "county string")
    assert rows(select_county(df, " middle EAST ")) == [("Middle East",)]
    assert select_county(df, None).count() == 2
