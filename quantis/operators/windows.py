"""Window operators: run ids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Width of the ranges of run_id.  An order column that numbers rows has at
# most this many rows in a range, wherever its values lie.
RUN_ID_RANGE = 1 << 20


def run_id(
    df: DataFrame,
    value: str,
    order: str | Sequence[str],
    by: Sequence[str] = (),
    *,
    bucket: str | None = None,
    width: int = RUN_ID_RANGE,
    out: str = "run_id",
) -> DataFrame:
    """``consecutive_id(value)``: 1-based id that increases whenever
    ``value`` differs from the previous row's (NULL equals NULL), in
    ``order`` within each ``by`` group.  Rows tied on the whole ``order``
    must carry the same ``value`` (end ``order`` with ``value`` to ensure
    it), otherwise the ids depend on an arbitrary tie order.

    A plain ``lag`` window would need every row of a ``by`` group in one
    task.  Instead rows are cut into ranges of ``bucket`` (numeric,
    non-decreasing along ``order``; default the first order column),
    ``width`` bucket values per range.  The width is fixed rather than
    derived from the extent of the data, so one outlying value cannot draw
    all other rows into one range, and no job runs before the query:

    1. inside each range: change flags from ``lag`` and their running sum;
    2. per range: first value, last value, number of inner changes -- a
       summary with one row per range;
    3. over the summary (small): does the range start a new run, and the
       id of its first row (running sum);
    4. join the summary back and add the local running count.

    A task holds the rows of ``width`` bucket values at most.  Where the
    bucket numbers rows that is ``width`` rows; a bucket value that many rows
    share is not split, so number the rows first in that case.
    """
    by = list(by)
    order = [order] if isinstance(order, str) else list(order)
    bucket = bucket or order[0]
    ocols = [F.col(f"`{o}`") for o in order]
    okey = F.struct(*ocols)
    d = df.withColumn("__b", F.floor(F.col(f"`{bucket}`") / F.lit(width)))
    wl = Window.partitionBy(*by, "__b").orderBy(*ocols)
    rn = F.row_number().over(wl)
    prev = F.lag(F.col(value)).over(wl)
    d = d.withColumn(
        "__chg",
        F.when(rn == 1, F.lit(0)).when(F.col(value).eqNullSafe(prev), F.lit(0)).otherwise(F.lit(1)),
    )
    d = d.withColumn(
        "__local", F.sum("__chg").over(wl.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    )
    s = d.groupBy(*by, "__b").agg(
        F.min_by(F.col(value), okey).alias("__first"),
        F.max_by(F.col(value), okey).alias("__last"),
        F.sum("__chg").alias("__inner"),
    )
    ws = Window.partitionBy(*by).orderBy("__b")
    has_prev = F.lag(F.lit(1)).over(ws).isNotNull()
    prev_last = F.lag("__last").over(ws)
    s = s.withColumn(
        "__entry",
        F.when(~has_prev, F.lit(1)).when(F.col("__first").eqNullSafe(prev_last), F.lit(0)).otherwise(F.lit(1)),
    )
    s = s.withColumn(
        "__base",
        F.sum(F.col("__entry") + F.col("__inner")).over(
            ws.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        )
        - F.col("__inner"),
    ).select(*by, "__b", "__base")
    joined = d.join(s, [*by, "__b"], "inner")
    return joined.withColumn(out, (F.col("__base") + F.col("__local")).cast("long")).select(
        *[F.col(f"`{c}`") for c in df.columns], out
    )
