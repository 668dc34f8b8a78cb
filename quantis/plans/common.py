"""Helpers shared by the pipelines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quantis.functions.text import county_key
from quantis.functions.values import money, money_total
from quantis.schemas import ITEM, NEW_PRICE, QTY, VALUE

COUNTY_FUNDING = "County"


def select_county(df: DataFrame, county: str | None) -> DataFrame:
    """Rows of one county (case-insensitive, as the table-suffix match it
    replaces), or all rows for ``None``.  On a ``county``-partitioned table
    the predicate prunes partitions."""
    if county is None:
        return df
    return df.where(county_key("county") == county.strip().lower())


def county_funded(df: DataFrame) -> DataFrame:
    return df.where(F.col("funding") == COUNTY_FUNDING)


def recomputed_value(price: str = "price_kes") -> Column:
    """``quantity x price`` as exact money (some analyses recompute the
    stored 12-month value)."""
    return (money(QTY) * money(price)).cast("decimal(18,4)")


def tn_value() -> Column:
    return recomputed_value(NEW_PRICE)


def sum_by(df: DataFrame, keys: list[str], value: str = VALUE) -> DataFrame:
    """Pre-aggregate facts to the grain the later joins and pivots need.

    The dimension joins of a report then meet one row per (county, tab,
    item, ...) instead of every fact row: partial aggregation map-side, one
    small shuffle, and no fact-sized join at any scale.  Exact decimal
    sums; a group whose values are all missing sums to NULL, which the
    pivot turns into 0 like ``sum(na.rm = TRUE)``."""
    return df.groupBy(*keys).agg(money_total(value).alias(value))


def keys() -> list[str]:
    """Join keys of the product dimensions."""
    return [ITEM, "tab"]


__all__ = [
    "COUNTY_FUNDING",
    "VALUE",
    "county_funded",
    "keys",
    "recomputed_value",
    "select_county",
    "sum_by",
    "tn_value",
]
