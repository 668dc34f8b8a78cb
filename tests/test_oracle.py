"""Every registered query against its independent DuckDB SQL (sf0.001).

The driver runs the same comparison at sf0.01; ``python
tests/oracle_check.py /root/testdata/sf0.01`` repeats it locally.
"""

import pytest

from quantis.catalog import QUERIES
from quantis.oracle import ORACLE_SQL
from tests.conftest import SF_SMALL
from tests.oracle_check import compare, duck


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE_SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, SF_SMALL)
    assert r["cols_match"], r
    assert r["rows"][0] == r["rows"][1], r
    assert r["exact"], r


ROBUST_SUBSET = [
    "by_product_or_equipment", "by_ven", "rmnch_share", "rmnch_value_pct", "requirements_by_ward_totals",
    "top_products", "top_categories_by_level", "workload_enrich", "ven_gaps", "item_run_ids", "assign_ward",
]


@pytest.fixture(scope="module")
def other_session(spark):
    """Same cluster, a differently configured SQL session: AQE off, ANSI off,
    many shuffle partitions, a non-UTC zone, zoned timestamps."""
    s = spark.newSession()
    for k, v in {
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.ansi.enabled": "false",
        "spark.sql.shuffle.partitions": "37",
        "spark.sql.session.timeZone": "America/Los_Angeles",
        "spark.sql.parquet.inferTimestampNTZ.enabled": "false",
    }.items():
        s.conf.set(k, v)
    return s


@pytest.mark.parametrize("name", ROBUST_SUBSET)
def test_results_do_not_depend_on_session_settings(other_session, con, name):
    r = compare(other_session, con, name, SF_SMALL)
    assert r["cols_match"] and r["rows"][0] == r["rows"][1] and r["exact"], r
