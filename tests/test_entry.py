"""The driver contract in __spark_entry__.py."""

import __spark_entry__ as entry_module


def test_entry_runs_the_flagship_query(spark):
    df = entry_module.entry(spark)
    assert df.columns == ["county", "tab", "Product", "Equipment", "NA", "Other", "Total"]
    rows = df.collect()
    assert len(rows) > 0
    assert {r["tab"] for r in rows} >= {"Total"}


def test_queries_and_oracle_cover_the_same_keys():
    from quantis.catalog import QUERIES

    q, o = entry_module.queries(), entry_module.oracle_sql()
    assert set(o) <= set(q)
    assert set(QUERIES) <= set(o)  # each of the library's own queries has SQL
    assert all(callable(f) for f in q.values())
    assert all(isinstance(s, str) and s.lstrip().upper().startswith("WITH") for s in o.values())
