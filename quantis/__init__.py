"""quantis: county health-commodity forecast analytics on Spark.

Layout
------
functions/  Column builders (label cleaning, VEN codes, exact sums, labels)
operators/  DataFrame operators (NULL-safe joins, crosstab with totals,
            top-k, keep-first, aligned union, run ids)
sources/    readers, sinks and the binding of the test tables to the domain
plans/      the user-level reports and checks
streaming/  intentionally empty (no streaming in the workload)
"""

__version__ = "0.1.0"
