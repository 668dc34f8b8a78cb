"""User-level pipelines (one function per report or check).

Every function takes DataFrames (and scalars), returns a DataFrame and
triggers no Spark action; ``DataFrame.transform`` chains them.  With
``county=None`` a report is computed for every county in one pass, with
``county`` as the leading key.
"""

from quantis.plans import classify, geo, reports, unify, workload

__all__ = ["classify", "geo", "reports", "unify", "workload"]
