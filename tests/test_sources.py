"""Sources and sinks: catalog union, landed CSV, report CSV, guarded table."""

import os
import tempfile

import pytest

from quantis.operators.columns import clean_names, drop_range, snake_case
from quantis.plans import workload as W
from quantis.sources import catalog_union, publish_table_once, write_report
from quantis.schemas import OLD_CATEGORIZATION
from tests.conftest import rows


def test_snake_case_like_janitor():
    assert snake_case("Organisation unit") == "organisation_unit"
    assert snake_case("facilityOwnership") == "facility_ownership"
    assert snake_case("  Keph  Level (ID) ") == "keph_level_id"
    assert snake_case("% of RMNCH") == "percent_of_rmnch"
    assert snake_case("2023 value") == "x2023_value"


def test_clean_names_dedupes(spark):
    df = spark.createDataFrame([(1, 2, 3)], "`A b` int, `a_b` int, `Value` int")
    assert clean_names(df).columns == ["a_b", "a_b_2", "value"]


def test_drop_range(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], "a int, b int, c int, d int")
    assert drop_range(df, "b", "c").columns == ["a", "d"]


def test_format_numbers(spark):
    from quantis.operators import format_numbers

    df = spark.createDataFrame([("c", 1234567.5, 2.5, None, 7)], "k string, a double, b double, c double, n long")
    assert rows(format_numbers(df, 0)) == [("c", "1,234,568", "2", None, "7")]
    assert rows(format_numbers(df, 1, skip=["n"]), "a", "n") == [("1,234,567.5", 7)]


def test_catalog_union_of_sub_county_tables(spark):
    a = spark.createDataFrame([("i", "t")], "item_description_name_form_strength string, tab string")
    b = spark.createDataFrame([("j", "u", "Equipment")], "item_description_name_form_strength string, tab string, product_or_equipment string")
    a.createOrReplaceTempView("lurambi_kakamega")
    b.createOrReplaceTempView("mumias_kakamega")
    spark.createDataFrame([("x", "y")], "item_description_name_form_strength string, tab string").createOrReplaceTempView("other_nakuru")
    u = catalog_union(spark, ".*_kakamega", OLD_CATEGORIZATION)
    assert sorted(rows(u), key=str) == sorted([("i", "t", None), ("j", "u", "Equipment")], key=str)


def test_landed_csv_extract_to_aggregate(spark):
    d = tempfile.mkdtemp(prefix="quantis-csv-")
    with open(os.path.join(d, "part-0.csv"), "w") as fh:
        fh.write("Data,Period,Organisation unit,Facility ownership,Keph level,Value,Numerator,Denominator,Factor,Multiplier,Divisor\n")
        fh.write("dx1,2023,F1,O0,K0,1.5,1,1,1,1,1\n")
        fh.write("dx1,2023,F1,O0,K0,2.25,1,1,1,1,1\n")
        fh.write("dx2,2022,F2,O1,K1,9,1,1,1,1,1\n")
    ext = W.workload_extract(W.landed_extract(spark, d), "2023", ["dx1", "dx2"], ["O0", "O1"], ["K0", "K1"])
    assert rows(W.workload_aggregate(ext)) == [("F1", "O0", "K0", 3.75)]


HEADER = "Data,Period,Organisation unit,Facility ownership,Keph level,Value,Numerator,Denominator,Factor,Multiplier,Divisor"


@pytest.mark.parametrize(
    "row",
    [
        "dx1,2023,F1,O0,K0,1.5",  # truncated
        "dx1,2023,F1,O0,K0,1.5,1,1,1,1,1,9,9",  # surplus fields
        "dx1,2023,F1,O0,K0,much,1,1,1,1,1",  # not a number
    ],
)
def test_landed_csv_fails_on_bad_rows(spark, tmp_path, row):
    (tmp_path / "part-0.csv").write_text(f"{HEADER}\ndx1,2023,F1,O0,K0,1.5,1,1,1,1,1\n{row}\n")
    ext = W.landed_extract(spark, str(tmp_path))
    with pytest.raises(Exception):
        W.workload_aggregate(W.workload_extract(ext, "2023", ["dx1"], ["O0"], ["K0"])).collect()


def test_landed_csv_needs_every_declared_column(spark, tmp_path):
    (tmp_path / "part-0.csv").write_text("Data,Period,Organisation unit,Facility ownership,Keph level\ndx1,2023,F1,O0,K0\n")
    with pytest.raises(ValueError, match="value"):
        W.landed_extract(spark, str(tmp_path))


def test_landed_csv_of_events_equals_the_table(spark, tmp_path):
    from quantis.catalog import QUERIES, WORKLOAD_ELEMENTS, WORKLOAD_LEVELS, WORKLOAD_OWNERSHIPS, WORKLOAD_PERIOD
    from quantis.sources import binding as B

    base = "/root/testdata/sf0.001"
    B.analytics(spark, base).write.option("header", True).csv(str(tmp_path / "landed"))
    ext = W.workload_extract(
        W.landed_extract(spark, str(tmp_path / "landed")), WORKLOAD_PERIOD, WORKLOAD_ELEMENTS, WORKLOAD_OWNERSHIPS, WORKLOAD_LEVELS
    )
    expect = QUERIES["workload_aggregate"](spark, base)
    assert sorted(rows(W.workload_aggregate(ext)), key=str) == sorted(rows(expect), key=str)


def test_small_workload_values_are_not_rounded_away(spark):
    from quantis.schemas import ANALYTICS

    one = ("d", "2024", "F1", "O0", "K0", 0.00004, 1.0, 1.0, 1.0, 1.0, 1.0)
    assert rows(W.workload_aggregate(spark.createDataFrame([one] * 10, ANALYTICS))) == [("F1", "O0", "K0", 0.0004)]


def test_a_hot_county_is_written_by_several_tasks(spark, tmp_path):
    df = spark.range(40000).selectExpr("if(id % 20 = 0, concat('C', id % 7), 'Hot') AS county", "id")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16k")
    try:
        write_report(df, str(tmp_path / "r"), per_county=True)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len([f for f in os.listdir(tmp_path / "r" / "county=Hot") if f.endswith(".csv")]) > 1
    assert spark.read.csv(str(tmp_path / "r"), header=True).count() == 40000


def test_command_line_keeps_the_submitted_master(tmp_path):
    """The runner must not replace the master it was submitted with."""
    import subprocess
    import sys

    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = (
        "import quantis.__main__ as m, pyspark.sql as s; "
        f"m.main(['distinct_counties', '/root/testdata/sf0.001', {str(tmp_path / 'o')!r}]); "
        "print('MASTER', s.SparkSession.getActiveSession().sparkContext.master)"
    )
    env = os.environ | {"PYSPARK_SUBMIT_ARGS": "--master local[2] --conf spark.ui.enabled=false pyspark-shell", "PYTHONPATH": repo}
    out = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True, timeout=300, cwd=repo)
    assert "MASTER local[2]" in out.stdout, out.stderr[-2000:]


def test_checkpoint_folder_must_be_shared_on_a_cluster():
    from types import SimpleNamespace

    from quantis.session import ensure_checkpoint_dir

    sc = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None)
    conf = SimpleNamespace(get=lambda key, default=None: default)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(SimpleNamespace(sparkContext=sc, conf=conf))


def test_write_report_csv(spark):
    d = os.path.join(tempfile.mkdtemp(prefix="quantis-rep-"), "report")
    df = spark.createDataFrame([("Total", 1.0)], "tab string, v double")
    write_report(df, d)
    back = spark.read.csv(d, header=True, schema="tab string, v double")
    assert rows(back) == [("Total", 1.0)]


def test_write_report_per_county(spark):
    d = os.path.join(tempfile.mkdtemp(prefix="quantis-rep-"), "report")
    df = spark.createDataFrame([("A", "t", 1.0), ("B", "t", 2.0), ("A", "Total", 1.0)], "county string, tab string, v double")
    write_report(df, d, per_county=True)
    parts = sorted(x for x in os.listdir(d) if x.startswith("county="))
    assert parts == ["county=A", "county=B"]
    assert all(len([f for f in os.listdir(os.path.join(d, p)) if f.endswith(".csv")]) == 1 for p in parts)


def test_pivot_discovery_is_capped(spark):
    import pytest

    from quantis.operators import crosstab

    spark.conf.set("spark.sql.pivotMaxValues", "3")
    try:
        df = spark.createDataFrame([("r", str(i), 1.0) for i in range(5)], "r string, k string, v double")
        with pytest.raises(ValueError):
            crosstab(df, ["r"], "k", "v")
    finally:
        spark.conf.unset("spark.sql.pivotMaxValues")


def test_publish_table_once(spark):
    first = spark.createDataFrame([("A", 1)], "county string, x int")
    second = spark.createDataFrame([("B", 2)], "county string, x int")
    assert publish_table_once(first, "all_counties_forecast_data") is True
    assert publish_table_once(second, "all_counties_forecast_data") is False
    assert rows(spark.table("all_counties_forecast_data")) == [("A", 1)]


def test_command_line_report(spark):
    from quantis.__main__ import main

    out = os.path.join(tempfile.mkdtemp(prefix="quantis-cli-"), "rep")
    assert main(["facilities_by_level", "/root/testdata/sf0.001", out, "--county", "asia",
                 "--order", "sub_county,keph_level,facility_name"]) == 0
    assert sorted(x for x in os.listdir(out) if x.startswith("county=")) == ["county=Asia"]
    part = [f for f in os.listdir(os.path.join(out, "county=Asia")) if f.endswith(".csv")]
    import csv

    with open(os.path.join(out, "county=Asia", part[0])) as fh:
        recs = [(r["sub_county"], r["keph_level"], r["facility_name"]) for r in csv.DictReader(fh)]
    assert recs and recs == sorted(recs)


def test_a_schema_is_read_again_when_the_table_changes(spark, tmp_path):
    from quantis.sources import clear_plans, read_table

    path = str(tmp_path / "things.parquet")
    spark.createDataFrame([(1,)], "a int").write.parquet(path)
    assert read_table(spark, str(tmp_path), "things").dtypes == [("a", "int")]
    clear_plans(spark)
    spark.sparkContext.setJobGroup("known schema", "")
    assert rows(read_table(spark, str(tmp_path), "things").limit(0)) == []
    clear_plans(spark)
    spark.createDataFrame([("x", 2.5)], "a string, b double").write.mode("overwrite").parquet(path)
    assert rows(read_table(spark, str(tmp_path), "things")) == [("x", 2.5)]
    clear_plans(spark)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
