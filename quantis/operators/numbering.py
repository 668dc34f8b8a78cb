"""Row numbers over a total order without one task seeing every row.

``row_number()`` over an order without partitions moves all rows into one
task.  Here rows are dealt into sorted ranges, each range is numbered on its
own, and the numbers are shifted by the counts of the ranges before it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quantis.session import ensure_checkpoint_dir

RANGE, PLACE = "__range", "__place"


def sorted_ranges(df: DataFrame, order: Sequence[str], ranges: int | None = None) -> DataFrame:
    """The rows in sorted ranges of about equal size, with the number of their
    range and their place in it.

    Rows that are equal in ``order`` keep the order in which they were read,
    and that place is part of the range boundaries: an order value that a
    third of the rows share is cut like any other run of rows.  The ranges are
    written to the checkpoint folder, because their boundaries are sampled and
    a second evaluation could deal the rows differently.  ``ranges`` defaults
    to the session's shuffle partitions, merged by AQE where they are small."""
    keys = [F.col(f"`{o}`") for o in order] + [F.col("__read")]
    read = df.withColumn("__read", F.monotonically_increasing_id())
    dealt = read.repartitionByRange(*([ranges] if ranges else []), *keys).sortWithinPartitions(*keys)
    ensure_checkpoint_dir(df.sparkSession)
    written = dealt.drop("__read").withColumn("__id", F.monotonically_increasing_id()).checkpoint(eager=True)
    # the id holds the partition above 33 bits and the place in it below
    return written.withColumns(
        {RANGE: F.shiftright("__id", 33), PLACE: F.col("__id").bitwiseAND(F.lit((1 << 33) - 1))}
    ).drop("__id")


def number_rows(
    df: DataFrame, order: str | Sequence[str], by: Sequence[str] = (), *, out: str = "row", ranges: int | None = None
) -> DataFrame:
    """Adds ``out``: 1, 2, 3, ... in ``order`` within each ``by`` group.

    Ascending, NULL first, as Spark sorts; rows that tie keep the order in
    which they were read.  One range shuffle; no task holds more than its
    range, whatever the sizes of the groups or the ties.  The counts of the
    ranges (one row for each range, and for each group that begins in it) are
    summed by a window and joined back."""
    by = list(by)
    order = [order] if isinstance(order, str) else list(order)
    dealt = sorted_ranges(df, [*by, *order], ranges)
    counts = dealt.groupBy(RANGE, *[F.col(f"`{b}`") for b in by]).agg(
        F.count(F.lit(1)).alias("__n"), F.min(PLACE).alias("__first")
    )
    before = Window.partitionBy(*[F.col(f"`{b}`") for b in by]).orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    shift = counts.select(
        F.col(RANGE).alias("__r"), *[F.col(f"`{b}`").alias(f"__by{i}") for i, b in enumerate(by)],
        (F.coalesce(F.sum("__n").over(before), F.lit(0)) - F.col("__first") + 1).alias("__shift"),
    )
    same = F.col(RANGE) == F.col("__r")
    for i, b in enumerate(by):
        same = same & F.col(f"`{b}`").eqNullSafe(F.col(f"__by{i}"))
    # without groups the summary has one row for each partition
    joined = dealt.join(shift if by else F.broadcast(shift), same)
    return joined.select(*[F.col(f"`{c}`") for c in df.columns], (F.col(PLACE) + F.col("__shift")).alias(out))
