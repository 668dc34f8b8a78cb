"""Spark query vs DuckDB oracle comparison (row count, column names, values).

Usable from pytest (``compare``) and as a script:

    python tests/oracle_check.py /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import math
import os
import sys
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def duck(base: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(base, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v, digits: int | None):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return round(v, digits) if digits is not None else v
    if hasattr(v, "as_integer_ratio") and not isinstance(v, (int, bool)):
        return float(v) if digits is None else round(float(v), digits)
    return v


def rows_of(cols: list[str], rows, digits: int | None) -> Counter:
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(_norm(r[i], digits) for i in order) for r in rows)


def compare(spark, con, name: str, base: str) -> dict:
    from quantis.catalog import QUERIES
    from quantis.oracle import ORACLE_SQL

    sdf = QUERIES[name](spark, base)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    res = con.execute(ORACLE_SQL[name])
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    out = {
        "name": name,
        "rows": (len(s_rows), len(d_rows)),
        "cols_match": sorted(s_cols) == sorted(d_cols),
        "exact": rows_of(s_cols, s_rows, None) == rows_of(d_cols, d_rows, None),
        "close": rows_of(s_cols, s_rows, 6) == rows_of(d_cols, d_rows, 6),
    }
    if not out["cols_match"]:
        out["cols"] = (sorted(s_cols), sorted(d_cols))
    if not out["close"]:
        a, b = rows_of(s_cols, s_rows, 6), rows_of(d_cols, d_rows, 6)
        out["only_spark"] = list((a - b).items())[:3]
        out["only_duck"] = list((b - a).items())[:3]
    return out


def main(argv: list[str]) -> int:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from quantis.oracle import ORACLE_SQL
    from quantis.session import local_session

    base = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:] or list(ORACLE_SQL)
    spark = local_session(8)
    con = duck(base)
    bad = 0
    for n in names:
        try:
            r = compare(spark, con, n, base)
        except Exception as e:  # report and keep going
            print(f"{n:36s} ERROR {type(e).__name__}: {str(e)[:800]}")
            bad += 1
            continue
        ok = r["cols_match"] and r["exact"] and r["rows"][0] == r["rows"][1]
        bad += not ok
        print(f"{n:36s} {'OK ' if ok else 'BAD'} rows={r['rows']} exact={r['exact']} close={r['close']}"
              + ("" if ok else f" {dict((k, v) for k, v in r.items() if k not in ('name',))}"))
    print("mismatches:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv))
