"""Write EXPLAIN.md: the final (adaptive) physical plans of key queries.

    python tools/explain.py [/root/testdata/sf0.1]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

KEY_QUERIES = {
    "by_product_or_equipment": "flagship crosstab: the fact stream is summed per (county, tab, item) "
    "map-side; only that aggregate meets the classification; cells and the total row come from "
    "conditional sums and GROUPING SETS over the small result",
    "requirements_by_ward": "facts aggregated per (facility, tab) before the hierarchy join",
    "assign_ward": "row-level ward assignment: null-safe joins whose strategy AQE picks by bytes",
    "top_products": "top-5 with ties: WindowGroupLimit before and after the shuffle",
    "ven_gaps": "keep-first as a partial aggregate (min_by), not a window",
    "item_run_ids": "consecutive_id by ranges: per-range windows, a small summary, a join back",
    "workload_enrich": "aggregate first, then the joins to org units and code lists",
}


# Operators that decide a plan's cost; projections, filters and stage markers
# are left out.
SHOWN = r"Exchange|Join|Aggregate|Window|Limit|Expand|FileScan|Sort|AQEShuffleRead"


def tree(df) -> str:
    plan = df._jdf.queryExecution().executedPlan().toString()
    lines = []
    skip_at = None
    for ln in plan.splitlines():
        # keep AQE's final plans, drop the repeated "Initial Plan" sections
        if "== Initial Plan ==" in ln:
            skip_at = len(ln) - len(ln.lstrip(" :+-"))
            continue
        if skip_at is not None:
            if len(ln) - len(ln.lstrip(" :+-")) > skip_at:
                continue
            skip_at = None
        ln = re.sub(r"#\d+L?|, \[plan_id=\d+\]", "", ln)
        if re.search(SHOWN, ln):
            lines.append(ln if len(ln) <= 110 else ln[:107] + "...")
    return "\n".join(lines)


def main() -> None:
    from quantis.catalog import QUERIES
    from quantis.session import local_session

    base = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(8, shuffle_partitions=16, app="quantis-explain")
    out = [
        "# Physical plans",
        "",
        f"Final adaptive plans (`executedPlan` after running that same plan) on `{base}`, local[8], "
        "generated by `tools/explain.py`. Only the operators that decide the cost are kept; long lines are cut.",
        "",
    ]
    for name, why in KEY_QUERIES.items():
        df = QUERIES[name](spark, base)
        df._jdf.queryExecution().toRdd().count()  # run this plan so AQE finalises it
        out += [f"## {name}", "", why + ".", "", "```", tree(df), "```", ""]
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "EXPLAIN.md")
    with open(path, "w") as fh:
        fh.write("\n".join(out))
    print(path)


if __name__ == "__main__":
    main()
