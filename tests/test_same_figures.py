"""Results do not depend on the width of a table, on the plan, or on how names are spelt."""

import json
import os

import pytest
from pyspark.sql import functions as F

from plumbline.operators.integrity import primary_key_check
from plumbline.operators.outliers import outlier_counts
from plumbline.operators.profile import column_profile
from plumbline.operators.skew import hot_keys
from plumbline.operators.snapshot import stamp_run
from plumbline.plans.checking import run_checks
from plumbline.plans.daily import run_daily
from plumbline.plans.policy import Range, TableRules
from plumbline.plans.rules import ALL_TABLES, evaluate_rules, read_rules
from plumbline.sources import load_table, read_documents, table_inventory
from plumbline.sources.writers import export_tables
from plumbline.streaming.monitor import daily_figures

MODES = ("exact", "approx", "none")


def decimals(spark, width):
    one = ", ".join(f"CAST(v AS DECIMAL(18,6)) AS c{i}" for i in range(width))
    return spark.sql(f"SELECT {one} FROM VALUES (0), (1), (1) AS t(v)")


@pytest.mark.parametrize("width", [2, 60])
@pytest.mark.parametrize("mode", MODES)
def test_mean_and_deviation_of_decimals(spark, width, mode):
    rows = column_profile(decimals(spark, width), "t", distinct=mode).collect()
    assert {(round(r["mean"], 12), round(r["stddev"], 12)) for r in rows} == {(0.666666666667, 0.57735026919)}


@pytest.mark.parametrize("mode", MODES)
def test_deviation_of_large_numbers_and_of_single_rows(spark, mode):
    df = spark.createDataFrame([(1e9 + i, None if i else 5) for i in range(4)], "a double, b long")
    found = {r["column_name"]: r["stddev"] for r in column_profile(df, "t", distinct=mode).collect()}
    assert found["a"] == pytest.approx(1.2909944487) and found["b"] is None


@pytest.mark.parametrize("width", [3, 101])
def test_outliers_of_empty_tables(spark, width):
    df = decimals(spark, width).limit(0)
    rows = outlier_counts(df, "t").collect()
    assert len(rows) == width and {(r["outlier_count"], r["mean"]) for r in rows} == {(0, None)}


def test_nested_values_are_told_apart(spark):
    df = spark.sql(
        """SELECT array(CAST(t AS TIMESTAMP)) AS at, array(CAST(t AS TIMESTAMP_NTZ)) AS ntz,
             array(CAST(z AS DOUBLE)) AS zero, named_struct('f', CAST(z AS FLOAT), 's', 'x') AS part
           FROM VALUES ('2024-01-01 00:00:00.000001', '0.0'), ('2024-01-01 00:00:00.000002', '-0.0') AS v(t, z)"""
    )
    found = {r["column_name"]: r["distinct_count"] for r in column_profile(df, "t").collect()}
    assert found == {"at": 2, "ntz": 2, "zero": 1, "part": 1}


def statuses(frame):
    return {(r["table_name"], r["check_type"], r["column_name"]): r["status"] for r in frame.collect()}


def test_names_are_resolved_and_nothing_vanishes(spark):
    df = spark.createDataFrame([(1, 5), (None, 50)], "a int, v int")
    rule = TableRules(critical=("A", "typo"), ranges={"V": Range(0, 10)}, primary_key=("a", "b"), freshness_hours=None)
    assert statuses(evaluate_rules({"t": df}, {"t": rule})) == {
        ("t", "null_checks", "a"): "FAIL",
        ("t", "range_checks", "v"): "FAIL",
        ("t", "null_checks", "typo"): "SKIP",
        ("t", "primary_key", "a, b"): "SKIP",
    }


def test_a_general_rule_without_a_column_is_skipped_once(spark):
    tables = {n: spark.createDataFrame([(1,)], f"{n} int") for n in ("a", "b")}
    rules = {n: TableRules(critical=("A", "typo"), freshness_hours=None, general=True) for n in tables}
    assert statuses(evaluate_rules(tables, rules)) == {
        ("a", "null_checks", "a"): "PASS",
        ("b", "rules", None): "SKIP",
        (ALL_TABLES, "null_checks", "typo"): "SKIP",
    }


def broken_file(folder):
    os.makedirs(folder)
    with open(f"{folder}/part-0.parquet", "wb") as file:
        file.write(b"PAR1 no table PAR1")
    return str(folder)


def test_broken_missing_and_unlisted_tables(spark, tmp_path):
    good = str(tmp_path / "good")
    spark.range(200).write.parquet(good)
    refs = {"good": good, "bad": broken_file(tmp_path / "bad"), "none": str(tmp_path / "none"), "extra": good}
    found = {r["table_name"]: r["status"] for r in table_inventory(spark, refs).collect()}
    assert found == {"good": "FOUND", "bad": "ERROR", "none": "SKIPPED", "extra": "FOUND"}
    copied = {r["table_name"]: r["status"] for r in export_tables(spark, refs, str(tmp_path / "copy")).collect()}
    assert copied == {"good": "EXPORTED", "bad": "ERROR", "none": "ERROR", "extra": "EXPORTED"}
    rules = {n: TableRules(critical=("id",), freshness_hours=None) for n in ("good", "bad", "none")}
    rules["good"] = TableRules(freshness_hours=None)
    paths = run_checks(spark, refs, rules, str(tmp_path / "out"), "20240101_000000", "2024-01-01 00:00:00")
    tables = spark.read.csv(paths["tables"], header=True)
    found = {r["table_name"]: r["overall_status"] for r in tables.collect()}
    assert found.keys() == refs.keys()
    assert (found["bad"], found["none"], found["extra"]) == ("ERROR", "SKIPPED", "PASS")


def test_a_table_of_ingest_columns_stops_no_other(spark, tmp_path):
    tables = {
        "bare": spark.createDataFrame([("2024-01-01",)], "ingestion_date string"),
        "good": spark.createDataFrame([(1,)], "a int"),
    }
    paths = run_daily(tables, str(tmp_path), "20240101_000000", "2024-01-01T00:00:00")
    detail = {r["table_name"]: r["column_name"] for r in spark.read.csv(paths["detail"], header=True).collect()}
    assert detail == {"bare": "ERROR", "good": "a"}


def test_one_rule_file_only(spark, tmp_path):
    for name in "ab":
        (tmp_path / f"{name}.json").write_text(json.dumps({"data_sources": {}}))
    assert read_rules(spark, str(tmp_path / "a.json")) == {}
    with pytest.raises(ValueError, match="one rule file"):
        read_rules(spark, str(tmp_path))


def test_run_ids_come_from_the_run_s_folder(spark, tmp_path):
    for run in ("20240102_000000", "20240103_000000"):
        spark.range(1).write.json(str(tmp_path / "job_20200101_000000" / f"run_id={run}"))
    path = str(tmp_path / "job_20200101_000000" / "run_id=*/*.json")
    found = read_documents(spark, path, "id long").select("run_id").collect()
    assert sorted(r["run_id"] for r in found) == ["20240102_000000", "20240103_000000"]


def test_only_a_missing_format_falls_back(spark, tmp_path):
    good = str(tmp_path / "good.parquet")
    spark.range(3).write.parquet(good)
    assert load_table(spark, good, "no_such_format").count() == 3
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        load_table(spark, str(tmp_path / "none"), "json")


@pytest.mark.parametrize("kind", ["int", "bigint", "decimal(10,2)", "double"])
def test_figures_of_arrivals_have_one_type(spark, kind):
    df = spark.sql(f"SELECT TIMESTAMP '2024-01-01 10:00:00' AS at, CAST(5 AS {kind}) AS v")
    figures = daily_figures(df, "at", "v", Range(0, 10))
    assert dict(figures.dtypes)["min_value"] == dict(figures.dtypes)["max_value"] == "double"


def test_long_keys_and_hot_keys(spark):
    long = "x" * 500
    df = spark.createDataFrame([(long + "a",), (long + "b",), (long + "b",), (None,)], "k string")
    found = primary_key_check(df, "t", ["k"]).first()
    assert (found["total_rows"], found["distinct_keys"], found["duplicate_keys"], found["status"]) == (4, 3, 1, "FAIL")
    assert "sha2" in primary_key_check(df, "t", ["k"])._jdf.queryExecution().toString()
    rows = spark.range(10_000).select(F.when(F.col("id") < 5000, 7).otherwise(F.col("id")).alias("k"))
    assert 7 in [r["k"] for r in hot_keys(rows, ["k"], 0.01).collect()]
    assert hot_keys(rows, ["k"], 0.01).count() <= 100


def test_the_source_of_a_stamp_is_an_argument(spark):
    stamped = stamp_run(spark.range(1), "2024-01-01", "run", source="parquet_fresh")
    assert stamped.first()["data_source"] == "parquet_fresh"
