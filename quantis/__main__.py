"""Run a registered report and write it, one file per county.

    python -m quantis list
    python -m quantis by_product_or_equipment /root/testdata/sf0.01 /tmp/out [--county asia] [--format csv]

The master and its settings come from the usual ``spark-submit`` / session
configuration (a master that was submitted is kept); run without one, Spark
starts its own local session.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from quantis.catalog import QUERIES
from quantis.plans.common import select_county
from quantis.sources.sinks import write_report


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="python -m quantis", description=__doc__.splitlines()[0])
    ap.add_argument("report", help="report name, or 'list'")
    ap.add_argument("tables", nargs="?", help="directory holding <table>.parquet inputs")
    ap.add_argument("out", nargs="?", help="output directory")
    ap.add_argument("--county", help="only this county (case-insensitive)")
    ap.add_argument("--format", default="csv", choices=["csv", "parquet"])
    ap.add_argument("--order", default="", help="comma-separated columns to sort each file by")
    a = ap.parse_args(argv)
    if a.report == "list":
        print("\n".join(sorted(QUERIES)))
        return 0
    if a.report not in QUERIES or not a.tables or not a.out:
        ap.error("need a known report, the tables directory and an output directory")
    spark = SparkSession.builder.appName("quantis").getOrCreate()
    df = QUERIES[a.report](spark, a.tables)
    if a.county:
        if "county" not in df.columns:
            ap.error(f"{a.report} has no county column")
        df = select_county(df, a.county)
    order = [c for c in a.order.split(",") if c]
    write_report(df, a.out, fmt=a.format, per_county="county" in df.columns and len(df.columns) > 1, order_by=order)
    return 0


if __name__ == "__main__":
    sys.exit(main())
