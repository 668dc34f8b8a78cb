"""Column-set operations: name cleaning, range drop, relocation.

These only rewrite the schema (a projection); no data moves.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType


def snake_case(name: str) -> str:
    """``janitor::make_clean_names`` default: split camelCase, lower-case,
    every run of non-alphanumerics -> ``_``, no leading/trailing ``_``,
    ``%`` spelt ``percent``; a name starting with a digit gets ``x``."""
    s = name.replace("%", " percent ")
    s = re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", s)
    s = re.sub(r"([A-Z]+)([A-Z][a-z])", r"\1_\2", s)
    s = re.sub(r"[^0-9A-Za-z]+", "_", s).strip("_").lower()
    if not s:
        s = "x"
    if s[0].isdigit():
        s = "x" + s
    return s


def clean_names(df: DataFrame) -> DataFrame:
    """Snake-case every column name; repeated results get ``_2``, ``_3``."""
    seen: dict[str, int] = {}
    out = []
    for c in df.columns:
        n = snake_case(c)
        seen[n] = seen.get(n, 0) + 1
        out.append(n if seen[n] == 1 else f"{n}_{seen[n]}")
    return df.toDF(*out)


def drop_range(df: DataFrame, first: str, last: str) -> DataFrame:
    """``select(-c(first:last))``: drop a contiguous range of columns."""
    cols = df.columns
    i, j = cols.index(first), cols.index(last)
    if j < i:
        i, j = j, i
    return df.drop(*cols[i : j + 1])


def format_numbers(df: DataFrame, decimals: int = 0, skip: Sequence[str] = ()) -> DataFrame:
    """Every numeric column (except ``skip``) as thousands-separated text
    with ``decimals`` places (``fmt_number(columns = 2:last_col())`` /
    ``mutate_if(is.numeric, format)``).  For presentation sinks only."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, NumericType) and f.name not in skip:
            c = F.format_number(c, decimals).alias(f.name)
        cols.append(c)
    return df.select(*cols)
