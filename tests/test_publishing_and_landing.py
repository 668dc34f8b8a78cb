"""Claims of publications, split tables read back, landed CSV of any header,
maps of undeclared pivots, and VEN resolution without broadcasts."""

import gzip
import os
import threading

import pytest
from pyspark.sql import functions as F

from quantis import schemas as S
from quantis.catalog import QUERIES
from quantis.operators import crosstab, crosstab_map
from quantis.plans import classify as C
from quantis.plans import unify as U
from quantis.plans import workload as W
from quantis.sources import ClaimedError, csv_headers, partition_values, publish_once, publish_table_once, sinks
from tests.conftest import SF_SMALL, rows


def table(spark, n=20):
    return spark.range(n).selectExpr("concat('C', id % 3) AS county", "id")


def test_of_two_writers_at_once_one_wins(spark, tmp_path):
    path, gate, results = str(tmp_path / "t"), threading.Barrier(2), []

    def write(mark):
        df = table(spark).withColumn("by", F.lit(mark))
        gate.wait()
        try:
            results.append((mark, publish_once(df, path)))
        except ClaimedError:
            results.append((mark, "claimed"))

    threads = [threading.Thread(target=write, args=(m,)) for m in ("one", "two")]
    [t.start() for t in threads]
    [t.join() for t in threads]
    winners = [m for m, r in results if r is True]
    assert len(winners) == 1 and len(results) == 2
    got = spark.read.parquet(path)
    assert got.count() == 20 and rows(got.select("by").distinct()) == [(winners[0],)]
    assert [x for x in os.listdir(tmp_path) if x != "t" and not x.startswith(".")] == []


def test_a_second_writer_inside_the_first_does_not_write(spark, tmp_path, monkeypatch):
    """The writers are interleaved step by step: the second runs whole while
    the first holds its staged files."""
    from quantis.sources import sinks

    path, move, seen = str(tmp_path / "t"), sinks._move, []

    def late(*args):
        with pytest.raises(ClaimedError):
            publish_once(table(spark, 5), path)
        seen.append(os.path.exists(path))
        return move(*args)

    monkeypatch.setattr(sinks, "_move", late)
    assert publish_once(table(spark), path) is True
    assert seen == [False]
    assert publish_once(table(spark, 5), path) is False
    assert spark.read.parquet(path).count() == 20


def test_a_dead_claim_raises_and_stays(spark, tmp_path):
    (tmp_path / "t.claim").write_text("token of a dead writer")
    with pytest.raises(ClaimedError, match="died"):
        publish_once(table(spark), str(tmp_path / "t"))
    assert not (tmp_path / "t").exists()
    (tmp_path / "t.claim").unlink()
    assert publish_once(table(spark), str(tmp_path / "t")) is True


def test_a_failed_write_leaves_nothing(spark, tmp_path):
    broken = table(spark).withColumn("x", F.when(F.col("id") == 7, F.raise_error(F.lit("broken"))).otherwise(F.lit("1")))
    with pytest.raises(Exception, match="broken"):
        publish_once(broken, str(tmp_path / "t"))
    assert [x for x in os.listdir(tmp_path) if not x.startswith(".")] == []


def test_the_rename_does_not_move_into_a_foreign_directory(spark, tmp_path, monkeypatch):
    from quantis.sources import sinks

    path, move = tmp_path / "t", sinks._move

    def late(*args):
        path.mkdir()
        (path / "foreign").write_text("x")
        return move(*args)

    monkeypatch.setattr(sinks, "_move", late)
    with pytest.raises(Exception):
        publish_once(table(spark), str(path))
    assert os.listdir(path) == ["foreign"]


def test_a_claimed_catalog_table_is_not_written(spark):
    name = "claimed_forecasts"
    folder = spark.catalog.getDatabase("default").locationUri.replace("file:", "")
    os.makedirs(folder, exist_ok=True)
    claim = os.path.join(folder, f"{name}.claim")
    with open(claim, "w") as f:
        f.write("x")
    with pytest.raises(ClaimedError):
        publish_table_once(table(spark), name)
    os.unlink(claim)
    assert publish_table_once(table(spark), name) is True and not os.path.exists(claim)
    assert publish_table_once(table(spark, 3), name) is False and spark.table(name).count() == 20


def test_split_counties_are_read_one_directory_at_a_time(spark, tmp_path):
    df = spark.createDataFrame(
        [("A b", "s", 1), ("A b", "s", 2), ("C=d", "t", 3), (None, "u", 4)], "county string, sub_county string, v int"
    ).withColumn(S.VALUE, F.col("v").cast("decimal(18,4)")).drop("v")
    path = str(tmp_path / "t")
    got = U.county_split_summary(df, path)
    assert sorted(((c, s, n, float(v)) for c, s, n, v in rows(got)), key=str) == sorted(
        [("A b", "s", 2, 3.0), ("C=d", "t", 1, 3.0), (None, "u", 1, 4.0)], key=str
    )
    assert partition_values(spark, path, "county") == ["A b", "C=d", None]
    plan = got._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("PartitionFilters: [") == 3 and "PartitionFilters: []" not in plan
    assert plan.count("county#") and all(x in plan for x in ("A b", "C=d", "isnull(county"))
    assert rows(U.county_split_summary(df.limit(0), str(tmp_path / "none"))) == []


ANY = "dx1,2023,F1,O0,K0,1.5,1,1,1,1,1"
HEADER = "Data,Period,Organisation unit,Facility ownership,Keph level,Value,Numerator,Denominator,Factor,Multiplier,Divisor"


def test_a_partitioned_write_does_not_sort_what_was_clustered(spark, tmp_path, monkeypatch):
    key, seen, deal = "spark.sql.maxConcurrentOutputFileWriters", [], sinks.rebalanced
    monkeypatch.setattr(sinks, "rebalanced", lambda df, by: seen.append(spark.conf.get(key)) or deal(df, by))
    rows = spark.range(1000).selectExpr("id", "cast(id % 40 as string) county")
    sinks.write_partitioned(rows, str(tmp_path / "split"))
    assert seen == [sinks.OPEN_FILES] and spark.conf.get(key) == "0"
    read = spark.read.parquet(str(tmp_path / "split"))
    assert read.count() == 1000 and read.select("county").distinct().count() == 40


def test_landed_files_of_any_column_order_and_spelling(spark, tmp_path):
    (tmp_path / "a.csv").write_text(f"{HEADER}\n{ANY}\n")
    turned = ",".join(reversed("data,period,organisationUnit,facilityOwnership,kephLevel,value,numerator,denominator,factor,multiplier,divisor".split(",")))
    (tmp_path / "b.csv").write_text(f"{turned}\n" + ",".join(reversed(ANY.replace("1.5", "2.25").split(","))) + "\n")
    (tmp_path / "empty.csv").write_text("")
    with gzip.open(tmp_path / "c.csv.gz", "wt") as f:
        f.write(f'extra,"{HEADER.replace(",", chr(34) + "," + chr(34))}"\nmore,{ANY.replace("1.5", "4")}\n')
    assert len(csv_headers(spark, str(tmp_path))) == 3
    ext = W.workload_extract(W.landed_extract(spark, str(tmp_path)), "2023", ["dx1"], ["O0"], ["K0"])
    assert rows(W.workload_aggregate(ext)) == [("F1", "O0", "K0", 7.75)]


@pytest.mark.parametrize(
    "header, match", [("Data,Period", "no column"), (HEADER + ",Data", "repeated"), ("", "no file with a header")]
)
def test_one_bad_header_fails(spark, tmp_path, header, match):
    if header:
        (tmp_path / "a.csv").write_text(f"{HEADER}\n{ANY}\n")
    (tmp_path / "b.csv").write_text(f"{header}\n" if header else "")
    with pytest.raises(ValueError, match=match):
        W.landed_extract(spark, str(tmp_path))


def test_a_map_crosstab_of_many_keys_runs_no_job_before_it_is_read(spark):
    df = spark.range(40_000).selectExpr("concat('c', id % 2) AS county", "concat('r', id % 2) AS r", "id % 20000 AS k", "cast(id AS double) AS v")
    spark.sparkContext.setJobGroup("map crosstab", "")
    out = crosstab_map(df, ["r"], "k", "v", by=["county"], row_total=True, total_col="Total")
    assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("map crosstab")) == []
    got = {(r["county"], r["r"]): r for r in out.collect()}
    spark.sparkContext.setJobGroup("rest", "")
    assert len(got) == 4 and all(len(r["cells"]) == 10_000 for r in got.values())
    assert got[("c0", "r0")]["cells"] == got[("c0", "Total")]["cells"]
    assert got[("c1", "r1")]["cells"]["1"] == 1.0 + 20_001.0
    assert sum(got[(c, "Total")]["Total"] for c in ("c0", "c1")) == 40_000 * 39_999 / 2


def test_a_map_crosstab_equals_the_wide_one(spark):
    df = spark.createDataFrame(
        [("a", "x", "V", 1.5), ("a", "x", None, 2.0), ("a", "y", "V", None), ("b", None, "E", 4.25), ("a", "x", "V", 0.25)],
        "county string, tab string, ven string, v double",
    )
    wide = crosstab(df, ["tab"], "ven", "v", ("V", "E", "NA"), by=["county"], row_total=True, col_total=True)
    maps = crosstab_map(df, ["tab"], "ven", "v", by=["county"], row_total=True, total_col="Total")
    got = {(r["county"], r["tab"]): (r["cells"], r["Total"]) for r in maps.collect()}
    assert len(got) == wide.count()
    for r in wide.collect():
        cells, total = got[(r["county"], r["tab"])]
        assert total == r["Total"] and all(cells.get(k, 0.0) == r[k] for k in ("V", "E", "NA"))


@pytest.fixture
def no_broadcast(spark):
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_resolved_rows_are_spread_when_the_list_is_too_long(spark, no_broadcast):
    """All rows are of one item; those with a VEN must not meet in one task."""
    df = spark.range(16_000).selectExpr(
        f"'i' AS {S.ITEM}", "'t' AS tab", "if(id % 4 = 0, null, 'V') AS ven", "id AS n"
    )
    new = spark.createDataFrame([("i", "t", "E", None), (None, "t", "N", None)], S.NEW_CATEGORIZATION)
    out = C.resolve_ven(df, new, "left")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan and "__spread" in plan
    sizes = sorted(r["count"] for r in out.filter("ven = 'V'").groupBy(F.spark_partition_id()).count().collect())
    assert len(sizes) > 4 and sizes[-1] < 2 * 12_000 / len(sizes)
    assert sorted(rows(out.groupBy("ven").count())) == [("E", 4_000), ("V", 12_000)]
    assert out.columns == [S.ITEM, "tab", "ven", "n"]


@pytest.mark.parametrize("how", ["left", "inner"])
def test_resolved_rows_carry_their_item_once(spark, no_broadcast, how):
    """Item and tab are the longest texts of a row: its join key is no copy of them."""
    df = spark.createDataFrame([("i", "t", None)], f"{S.ITEM} string, tab string, ven string")
    new = spark.createDataFrame([("i", "t", "E", None)], S.NEW_CATEGORIZATION)
    out = C.resolve_ven(df, new, how)
    dealt = [ln for ln in out._jdf.queryExecution().executedPlan().toString().splitlines() if "Project" in ln and "__spread" in ln and "xxhash64" in ln]
    assert dealt and all("CASE" in ln and ln.count("CASE") == 1 for ln in dealt), dealt
    assert rows(out) == [("i", "t", "E")]


def test_null_keys_of_resolved_rows_match_nothing(spark, no_broadcast):
    df = spark.createDataFrame([(None, "t", "V"), (None, "t", None), ("i", None, None)], f"{S.ITEM} string, tab string, ven string")
    new = spark.createDataFrame([(None, "t", "N", None), (None, None, "E", None)], S.NEW_CATEGORIZATION)
    assert sorted(rows(C.resolve_ven(df, new, "left")), key=str) == sorted(
        [(None, "t", "V"), (None, "t", "N"), ("i", None, None)], key=str
    )
    assert len(rows(C.resolve_ven(df, new, "inner"))) == 2


def test_a_county_found_by_its_table_suffix(spark):
    got = QUERIES["county_forecasts_discovered"](spark, SF_SMALL)
    expected = QUERIES["county_forecasts"](spark, SF_SMALL)
    assert sorted(rows(got), key=str) == sorted(rows(expected), key=str)
    assert not [t for t in spark.catalog.listTables() if t.name.endswith("_asia")]
