"""Benchmark: registered queries on $BENCH_SF_DIR with local[$BENCH_CPUS].

Each query is run to completion through the ``noop`` sink (full execution,
nothing collected to the driver): one warm-up run, then the median of
$BENCH_RUNS timed runs, each starting with an empty cache.  Prints one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py [query ...]
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def bench_pack(spark, base: str, times: dict[str, float]) -> dict:
    """The 11 product reports of a county pack from one shared, checkpointed
    cube, against the same reports each reading the facts (from ``times``)."""
    from quantis.catalog import KEPH_LEVELS
    from quantis.plans.reports import product_report_pack
    from quantis.sources import binding as B

    def run() -> None:
        reps = product_report_pack(
            B.forecasts(spark, base), B.product_classifications(spark, base), B.new_product_categorization(spark, base),
            levels=KEPH_LEVELS,
        )
        for df in reps.values():
            df.write.format("noop").mode("overwrite").save()

    # every report shape is already warm from the per-query runs: one timed run
    spark.catalog.clearCache()
    t0 = time.perf_counter()
    run()
    samples = [time.perf_counter() - t0]
    names = ("by_product_or_equipment", "by_ven", "ven_totals", "ven_totals_resolved", "rmnch_share",
             "rmnch_value_pct", "rmnch_summary", "top_products", "top_categories", "top_categories_by_level",
             "top_categories_by_ven")
    separate = sum(times[n] for n in names if n in times)
    return {"reports": len(names), "from_shared_cube": round(statistics.median(samples), 3),
            "separately": round(separate, 3) if all(n in times for n in names) else None}


def main(argv: list[str]) -> None:
    base = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    from quantis.catalog import QUERIES
    from quantis.session import local_session

    spark = local_session(cpus, shuffle_partitions=max(8, 2 * cpus), app="quantis-bench")
    names = argv[1:] or list(QUERIES)
    times: dict[str, float] = {}
    for name in names:
        q = QUERIES[name]
        q(spark, base).write.format("noop").mode("overwrite").save()  # warm-up: JIT, codegen cache
        samples = []
        for _ in range(runs):
            t0 = time.perf_counter()
            q(spark, base).write.format("noop").mode("overwrite").save()
            samples.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(samples), 3)
    pack = {}
    if os.environ.get("BENCH_PACK", "1") != "0":
        pack = bench_pack(spark, base, times)
    m = re.search(r"sf([0-9.]+)", base)
    print(
        json.dumps(
            {
                "metric": "total_median_query_time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(m.group(1)) if m else base,
                "cpus": cpus,
                "runs": runs,
                "spark": spark.version,
                "pack": pack,
            }
        )
    )


if __name__ == "__main__":
    main(sys.argv)
