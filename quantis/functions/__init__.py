"""Column builders: text cleaning, VEN sanitising, exact sums, labels."""

from quantis.functions.text import (
    clean_tab,
    county_key,
    detect,
    remove_all,
    remove_first,
    remove_first_literal,
    strip_org_suffix,
    title_case,
)
from quantis.functions.values import (
    MONEY,
    MONEY_SUM,
    money_total,
    VEN_CODES,
    money,
    number_label,
    pct_label,
    round_half_even,
    safe_share,
    sum_money,
    thousands,
    ven_or_null,
)

__all__ = [
    "MONEY",
    "MONEY_SUM",
    "money_total",
    "VEN_CODES",
    "clean_tab",
    "county_key",
    "detect",
    "money",
    "number_label",
    "pct_label",
    "remove_all",
    "remove_first",
    "remove_first_literal",
    "round_half_even",
    "safe_share",
    "strip_org_suffix",
    "sum_money",
    "thousands",
    "title_case",
    "ven_or_null",
]
