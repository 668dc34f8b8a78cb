"""Crosstab reports: ``summarise`` + ``pivot_wider`` + ``adorn_totals``.

Plan shape (checked with ``explain``): one partial + final hash aggregate
reduces the fact rows to one row per (by, rows, key) -- the only shuffle
that sees fact-sized data -- then conditional sums over that small result
build the wide cells.  Total rows come from ``GROUPING SETS`` over the small
result and are labelled with ``grouping()`` rather than a null test, because
real NULL row keys exist.  ``pivot`` after ``rollup`` is rejected by Spark,
and a second full scan for the totals is avoided.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# Report labels of the tidyverse reports -- a missing pivot
# key is the column "NA"; a total row is "Total" in its first key column and
# "-" in the other text columns; the total column is "Total".
NA_LABEL = "NA"
TOTAL_LABEL = "Total"
OTHER_LABEL = "-"

# Report column of the values outside a declared list: they are shown and
# counted, never dropped.
OTHER_VALUES = "Other"


def discover_values(df: DataFrame, key: str | Column, na_label: str = NA_LABEL) -> list[str]:
    """Distinct pivot keys, sorted (NULL -> ``na_label``).

    This runs one aggregate job and brings back only the distinct key set,
    at most ``spark.sql.pivotMaxValues`` of them (Spark's own ``pivot``
    without values does the same).  Pass explicit values whenever the
    domain is known, for a stable schema.
    """
    k = F.col(key) if isinstance(key, str) else key
    cap = int(df.sparkSession.conf.get("spark.sql.pivotMaxValues", "10000"))
    keys = df.select(F.coalesce(k.cast("string"), F.lit(na_label)).alias("k")).distinct().limit(cap + 1).collect()
    if len(keys) > cap:
        raise ValueError(f"more than {cap} distinct pivot values; pass values explicitly")
    return sorted(r.k for r in keys)


def crosstab(
    df: DataFrame,
    rows: Sequence[str],
    key: str,
    value: str,
    values: Sequence[str] | None = None,
    *,
    by: Sequence[str] = (),
    fill: bool = True,
    na_label: str = NA_LABEL,
    row_total: bool = False,
    col_total: bool = False,
    total_label: str = TOTAL_LABEL,
    other_label: str = OTHER_LABEL,
    total_col: str = TOTAL_LABEL,
    exact: bool = True,
    pre_aggregated: bool = False,
    total_flag: str | None = None,
    other_col: str = OTHER_VALUES,
) -> DataFrame:
    """Wide ``rows`` x ``key`` table of ``sum(value)``.

    * ``by`` -- outer keys; every report is computed per ``by`` group in
      one pass (e.g. all counties at once) and totals are per group.
    * ``values`` -- pivot columns in output order; a NULL key is reported
      under ``na_label``.  Every other value is summed into ``other_col``,
      the last column before the total, so no value is ever left out.
      ``None`` discovers the values with a job while the plan is built (and
      has no ``other_col``): declare them where the domain is known.
    * ``fill`` -- absent cells are 0 (``values_fill = 0``); otherwise NULL.
      A cell whose group exists but sums only missing values is 0 either
      way, as with ``sum(na.rm = TRUE)``.
    * ``row_total`` -- a total row per ``by`` group: the first row key is
      ``total_label``, later row keys ``other_label``; cells sum the cells.
    * ``col_total`` -- a ``total_col`` column summing every value of the row,
      listed or not, missing cells ignored.
    * ``exact`` -- sum in ``decimal(38,4)`` and return double, so results
      do not depend on partial-aggregate order.
    * ``pre_aggregated`` -- ``df`` already has one row per (by, rows, key).
    * ``total_flag`` -- name of a boolean output column marking total rows.

    Built for report-width pivots (tens to a few hundred columns): each
    pivot value adds two conditional sums to one aggregate over the small
    long form.
    """
    rows, by = list(rows), list(by)
    kname = "__key"
    keyed = df.withColumn(kname, F.coalesce(F.col(key).cast("string"), F.lit(na_label)))
    # exact: wide decimal, so pre-aggregated sums cannot overflow the cast
    v = F.col(value).cast("decimal(38,4)") if exact else F.col(value).cast("double")
    if pre_aggregated:
        long = keyed.select(*by, *rows, kname, v.alias("__v"), F.lit(1).alias("__n"))
    else:
        long = keyed.groupBy(*by, *rows, kname).agg(
            F.sum(v).alias("__v"), F.count(F.lit(1)).alias("__n")
        )
    declared = values is not None
    values = list(values) if declared else discover_values(long, kname)
    if declared and other_col in values:
        raise ValueError(f"{other_col!r} is a declared value; name the column of other values differently")

    zero = F.lit(0).cast("decimal(38,4)" if exact else "double")
    aggs = []
    hits = [F.col(kname) == F.lit(val) for val in values]
    if declared:
        hits.append(~F.col(kname).isin(*values))
    for i, hit in enumerate(hits):
        aggs.append(F.coalesce(F.sum(F.when(hit, F.col("__v"))), zero).alias(f"__s{i}"))
        aggs.append(F.coalesce(F.sum(F.when(hit, F.col("__n"))), F.lit(0)).alias(f"__c{i}"))
    if col_total:
        aggs.append(F.coalesce(F.sum("__v"), zero).alias("__tot"))

    if row_total:
        sets = [[*by, *rows], list(by)]
        gcols = [F.col(c) for c in by + rows]
        wide = long.groupingSets(sets, *gcols).agg(*aggs, F.grouping(rows[0]).alias("__g"))
        is_total = F.col("__g") == 1
        keys = []
        for i, r in enumerate(rows):
            lab = total_label if i == 0 else other_label
            keys.append(F.when(is_total, F.lit(lab)).otherwise(F.col(r).cast("string")).alias(r))
    else:
        wide = long.groupBy(*by, *rows).agg(*aggs)
        is_total = F.lit(False)
        keys = [F.col(r) for r in rows]

    def cell(i: int) -> Column:
        s = F.col(f"__s{i}")
        # an absent cell is NULL without fill; a total row sums with na.rm
        return s if fill else F.when(is_total | (F.col(f"__c{i}") > 0), s)

    names = [*values, other_col] if declared else values
    out = [cell(i).cast("double").alias(val) for i, val in enumerate(names)]
    if col_total:
        out.append(F.col("__tot").cast("double").alias(total_col))
    if total_flag:
        out.append(is_total.alias(total_flag))
    return wide.select(*by, *keys, *out)


def crosstab_map(
    df: DataFrame,
    rows: Sequence[str],
    key: str,
    value: str,
    *,
    by: Sequence[str] = (),
    na_label: str = NA_LABEL,
    row_total: bool = False,
    total_label: str = TOTAL_LABEL,
    other_label: str = OTHER_LABEL,
    cells: str = "cells",
    total_col: str | None = None,
) -> DataFrame:
    """:func:`crosstab` for a key whose values are not known: one row per
    (by, rows) with a map from key to exact sum (as double) instead of one
    column per value.

    Nothing is discovered: no job runs while the plan is built, the schema
    does not depend on the data, and there is no limit on the number of
    values.  Keys without a cell are absent (``values_fill`` has no meaning
    here); a cell whose values are all missing is 0; a NULL key is
    ``na_label``.  Keys are in ascending order.  ``row_total`` adds a row for
    each ``by`` group that holds the union of its rows' maps, cells of one key
    summed; ``total_col`` adds the sum of a row's cells.

    The facts are summed to one row per (by, rows, key) with partial
    aggregation before any map is built, and the total row is made from these
    sums, so a frequent key or a large group costs one row a task."""
    rows, by = list(rows), list(by)
    amount = F.col(value).cast("decimal(38,4)")
    keyed = df.withColumn("__key", F.coalesce(F.col(key).cast("string"), F.lit(na_label)))
    long = keyed.groupBy(*by, *rows, "__key").agg(F.sum(amount).alias("__v"))
    if row_total:
        sets = [[*by, *rows, "__key"], [*by, "__key"]]
        long = long.groupingSets(sets, *[F.col(c) for c in [*by, *rows, "__key"]]).agg(
            F.sum("__v").alias("__v"), F.grouping(rows[0]).alias("__g")
        )
    else:
        long = long.withColumn("__g", F.lit(0).cast("tinyint"))
    cell = F.coalesce(F.col("__v"), F.lit(0).cast("decimal(38,4)"))
    entries = F.sort_array(F.collect_list(F.struct(F.col("__key").alias("key"), cell.cast("double").alias("value"))))
    out = [F.map_from_entries(entries).alias(cells)]
    if total_col:
        out.append(F.sum(cell).cast("double").alias(total_col))
    wide = long.groupBy(*by, *rows, "__g").agg(*out)
    names = [total_label] + [other_label] * (len(rows) - 1)
    keys = [F.when(F.col("__g") == 1, F.lit(n)).otherwise(F.col(r).cast("string")).alias(r) if row_total else F.col(r) for r, n in zip(rows, names, strict=True)]
    return wide.select(*by, *keys, cells, *([total_col] if total_col else []))
