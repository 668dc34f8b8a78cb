"""Name-matched unions (``bind_rows`` / ``map_df``)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, NullType, StructType


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Project ``df`` onto ``schema``: columns by name, absent columns
    NULL-filled, extra columns dropped.  A column of another type raises
    (``bind_rows`` errors on a clash); only an untyped NULL column is cast."""
    have = {f.name: f.dataType for f in df.schema.fields}
    cols = []
    for f in schema.fields:
        if f.name in have:
            if have[f.name] not in (f.dataType, NullType()):
                raise TypeError(f"{f.name}: {have[f.name].simpleString()} instead of {f.dataType.simpleString()}")
            cols.append(F.col(f"`{f.name}`").cast(f.dataType).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*cols)


def union_aligned(frames: Sequence[DataFrame], schema: StructType | None = None) -> DataFrame:
    """UNION ALL of frames matched by column name.

    With ``schema`` every frame must have the declared types: a clash raises
    instead of being coerced.  Without it, missing columns are NULL-filled and
    columns of one name must have one type.
    """
    if not frames:
        raise ValueError("union_aligned needs at least one frame")
    if schema is not None:
        frames = [conform(f, schema) for f in frames]
        return reduce(DataFrame.unionByName, frames)
    kinds: dict[str, DataType] = {}
    for f in (f for frame in frames for f in frame.schema.fields):
        if kinds.setdefault(f.name, f.dataType) != f.dataType:
            raise TypeError(f"{f.name}: {f.dataType.simpleString()} and {kinds[f.name].simpleString()}")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
