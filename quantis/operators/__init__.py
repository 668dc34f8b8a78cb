"""Composite DataFrame operators built from public DataFrame API only."""

from quantis.operators.columns import clean_names, drop_range, format_numbers, snake_case
from quantis.operators.crosstab import crosstab, crosstab_map, discover_values
from quantis.operators.joins import anti_join, null_safe_join, semi_join
from quantis.operators.numbering import number_rows
from quantis.operators.ranking import first_n_per_group, keep_first, max_per_group, top_n
from quantis.operators.sets import conform, union_aligned
from quantis.operators.trees import CycleError, descend
from quantis.operators.windows import run_id

__all__ = [
    "anti_join",
    "clean_names",
    "drop_range",
    "format_numbers",
    "snake_case",
    "conform",
    "crosstab",
    "crosstab_map",
    "CycleError",
    "descend",
    "discover_values",
    "first_n_per_group",
    "keep_first",
    "max_per_group",
    "null_safe_join",
    "number_rows",
    "run_id",
    "semi_join",
    "top_n",
    "union_aligned",
]
