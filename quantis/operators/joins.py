"""Equi-joins with dplyr key semantics.

dplyr matches ``NA`` to ``NA`` in join keys; Spark's ``==`` does not.  The
joins here compare keys with ``<=>`` (``eqNullSafe``).  Catalyst still
extracts such keys as equi-join keys (``coalesce(k, default), isnull(k)``),
so the join stays eligible for broadcast-hash and sort-merge strategies and
for AQE's skew-split of the large side.

Broadcast policy: nothing here forces a broadcast.  The optimizer broadcasts
a side only after measuring it in bytes (static statistics against
``spark.sql.autoBroadcastJoinThreshold``, and at run time through AQE's
``spark.sql.adaptive.autoBroadcastJoinThreshold``) and otherwise plans a
shuffled join.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KeySpec = str | tuple[str, str]


def _pairs(on: KeySpec | Sequence[KeySpec]) -> list[tuple[str, str]]:
    if isinstance(on, (str, tuple)):
        on = [on]
    return [(k, k) if isinstance(k, str) else (k[0], k[1]) for k in on]


def null_safe_join(
    left: DataFrame,
    right: DataFrame,
    on: KeySpec | Sequence[KeySpec],
    how: str = "left",
    extra: Column | None = None,
) -> DataFrame:
    """Join ``left`` to ``right`` matching NULL keys to each other.

    ``on`` holds column names shared by both sides or ``(left, right)``
    pairs.  The result keeps the left key columns once, followed by the
    right side's non-key columns (none for semi / anti joins).  Clashing
    non-key names raise instead of silently producing ambiguous columns;
    rename first.  ``extra`` is an additional join condition written
    against the right side's temporary key aliases or any column name that
    is unique across both sides.
    """
    pairs = _pairs(on)
    rkeys = {r for _, r in pairs}
    rest = [c for c in right.columns if c not in rkeys]
    if how not in ("left_semi", "left_anti", "semi", "anti"):
        clash = sorted(set(rest) & set(left.columns))
        if clash:
            raise ValueError(f"non-key columns on both sides: {clash}; rename first")
    tmp = {r: f"__rk{i}" for i, (_, r) in enumerate(pairs)}
    r = right.select([F.col(f"`{k}`").alias(v) for k, v in tmp.items()] + [F.col(f"`{c}`") for c in rest])
    cond = reduce(
        lambda a, b: a & b,
        [left[f"`{lk}`"].eqNullSafe(r[tmp[rk]]) for lk, rk in pairs],
    )
    if extra is not None:
        cond = cond & extra
    out = left.join(r, cond, how)
    if how in ("left_semi", "left_anti", "semi", "anti"):
        return out
    return out.drop(*tmp.values())


def semi_join(left: DataFrame, right: DataFrame, on: KeySpec | Sequence[KeySpec]) -> DataFrame:
    """Rows of ``left`` with a key in ``right`` (``x %in% pull(y, k)``),
    without collecting the key list to the driver."""
    return null_safe_join(left, right, on, "left_semi")


def anti_join(left: DataFrame, right: DataFrame, on: KeySpec | Sequence[KeySpec]) -> DataFrame:
    """Rows of ``left`` whose key is absent from ``right`` (NULL matches
    NULL, as in dplyr)."""
    return null_safe_join(left, right, on, "left_anti")
