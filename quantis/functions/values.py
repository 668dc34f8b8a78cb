"""Numeric and presentation column builders (all built-in Spark SQL)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# The three valid VEN codes (vital, essential, non-essential).
VEN_CODES = ("V", "E", "N")

# Exact money types: values are decimal(18,4); sums accumulate in
# decimal(38,4), so totals are exact, independent of the order partial
# aggregates are combined in, and cannot overflow when sums are re-summed.
MONEY = "decimal(18,4)"
MONEY_SUM = "decimal(38,4)"


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c: ColumnOrName) -> Column:
    return _col(c).cast(MONEY)


def money_total(c: ColumnOrName) -> Column:
    """Exact sum of a money column (value or already a partial sum), as
    ``decimal(38,4)``; NULL for an all-missing group."""
    return F.sum(_col(c).cast(MONEY_SUM))


def sum_money(c: ColumnOrName) -> Column:
    """Exact sum of a money column, 0 for an empty group, as double."""
    return F.coalesce(money_total(c), F.lit(0).cast(MONEY_SUM)).cast("double")


def ven_or_null(c: ColumnOrName = "ven") -> Column:
    """Any VEN outside {V, E, N} (including NULL and lower case) -> NULL."""
    x = _col(c)
    return F.when(x.isin(*VEN_CODES), x)


def safe_share(part: ColumnOrName, whole: ColumnOrName) -> Column:
    """``part / whole`` as double; ``0/0`` gives NULL instead of an ANSI
    error (R would give NaN)."""
    return F.try_divide(_col(part).cast("double"), _col(whole).cast("double"))


def round_half_even(c: ColumnOrName, digits: int = 2) -> Column:
    """R >= 4 ``round``: ties to even."""
    return F.bround(_col(c), digits)


def number_label(c: ColumnOrName) -> Column:
    """Number -> text the way R prints it: no trailing ``.0`` (``50``,
    ``33.33``)."""
    return F.regexp_replace(_col(c).cast("string"), r"\.0$", "")


def pct_label(ratio: ColumnOrName, digits: int = 2) -> Column:
    """``str_c(round(ratio * 100, 2), "%")``; NULL ratio stays NULL."""
    return F.concat(number_label(round_half_even(_col(ratio) * 100, digits)), F.lit("%"))


def thousands(c: ColumnOrName, decimals: int = 0) -> Column:
    """Thousands-separated text for presentation sinks only."""
    return F.format_number(_col(c), decimals)
