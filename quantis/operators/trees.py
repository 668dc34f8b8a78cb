"""Closure of adjacency lists (id, parent) of any depth."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quantis.session import ensure_checkpoint_dir


class CycleError(ValueError):
    """Units that no root reaches because their parents lead back to them."""


def descend(units: DataFrame, id_col: str, parent_col: str, paths: Mapping[str, str]) -> DataFrame:
    """``units`` with ``depth`` (0 for a root) and, for each ``name: column``
    of ``paths``, an array of that column's values from the root to the unit.

    Level by level: the units of one level, written to the checkpoint folder,
    are joined with their children, so every unit is joined once, and a parent
    of very many children is split by AQE as any skewed join key.  Roots are
    units without a parent or with one that is not listed.  What no level
    reached is in or below a cycle: that raises, with an example.  A repeated
    id raises too, because its children would be repeated."""
    ensure_checkpoint_dir(units.sparkSession)
    listed = units.filter(F.col(id_col).isNotNull()).checkpoint(eager=True)
    twice = listed.groupBy(id_col).count().filter("count > 1").head()
    if twice is not None:
        raise ValueError(f"{id_col} {twice[0]!r} is listed {twice['count']} times")
    known = listed.select(F.col(id_col).alias("__known"))
    parent = F.col(parent_col)
    level = listed.join(known, parent == F.col("__known"), "left_anti").select(
        "*", F.lit(0).alias("depth"), *[F.array(F.col(c)).alias(n) for n, c in paths.items()]
    ).checkpoint(eager=True)
    found, reached = level, level.count()
    while not level.isEmpty():
        above = level.select(F.col(id_col).alias("__above"), F.col("depth").alias("__depth"), *[F.col(n).alias(f"__{n}") for n in paths])
        below = listed.join(above, parent == F.col("__above"))
        level = below.select(
            *listed.columns, (F.col("__depth") + 1).alias("depth"),
            *[F.concat(F.col(f"__{n}"), F.array(F.col(c))).alias(n) for n, c in paths.items()],
        ).checkpoint(eager=True)
        found, reached = found.union(level), reached + level.count()
    if reached < listed.count():
        lost = listed.join(found.select(F.col(id_col).alias("__found")), F.col(id_col) == F.col("__found"), "left_anti")
        raise CycleError(f"{lost.count()} units are in or below a cycle, such as {lost.agg(F.min(id_col)).first()[0]!r}")
    return found
