import pytest

from plumbline.operators import rollup
from plumbline.operators.checks import column_findings, volume_change_checks, volume_checks
from plumbline.operators.profile import column_profile
from plumbline.operators.table_checks import (
    castable_checks,
    freshness_check,
    range_checks,
    row_counts,
    split_quarantine,
)
from plumbline.plans.policy import Range, TableRules
from plumbline.plans.rules import evaluate_rules, parse_rules


def test_range_tolerance(spark):
    df = spark.range(1000).selectExpr("CASE WHEN id < 7 THEN -1.0 ELSE 1.0 END AS v")
    row = range_checks(df, "t", {"v": Range(0, 10)}).first()
    assert (row.violations, round(row.violation_pct, 2), row.status) == (7, 0.7, "PASS")
    assert range_checks(df, "t", {"v": Range(0, 10)}, 0.0).first().status == "FAIL"


def test_null_is_no_violation_and_nan_is_one(spark):
    df = spark.createDataFrame([(None,), (float("nan"),), (1.0,), (0.0,), (10.0,)], "v double")
    assert range_checks(df, "t", {"v": Range(0, 10)}).first().violations == 1


def test_range_of_an_empty_table_passes(spark):
    df = spark.createDataFrame([], "v double")
    row = range_checks(df, "t", {"v": Range(0, 1)}, 0.0).first()
    assert (row.total_rows, row.violation_pct, row.status) == (0, 0.0, "PASS")


def test_no_range_rules_pass_with_a_message(spark):
    row = range_checks(spark.range(3).toDF("v"), "t", {"w": Range(0, 1)}).first()
    assert (row.status, row.message) == ("PASS", "No range rules defined for this table")


@pytest.mark.parametrize("rows, status", [(99, "FAIL"), (100, "PASS"), (200, "PASS"), (201, "FAIL")])
def test_volume_limits_are_inclusive(spark, rows, status):
    counts = row_counts(spark.range(rows).toDF("v"), "t")
    assert volume_checks(counts, {"t": Range(100, 200)}).first().status == status


def test_volume_messages(spark):
    counts = row_counts(spark.range(1234).toDF("v"), "t")
    low = volume_checks(counts, {"t": Range(2000, 3000)}).first()
    assert low.message == "Record count 1,234 below minimum 2,000"
    assert volume_checks(counts, {"u": Range(1, 2)}).first().max_threshold == 1_000_000
    both = volume_checks(counts, {"t": Range(2000, 3000)}, name_limits=True).first()
    assert both.message == "Record count 1,234 outside range (2,000-3,000)"


@pytest.mark.parametrize("rows, status", [(0, "CRITICAL"), (49, "WARNING"), (50, "PASS")])
def test_volume_change(spark, rows, status):
    counts = spark.sql(f"SELECT 't' AS table_name, {rows}L AS record_count, 100.0D AS expected_count")
    assert volume_change_checks(counts).first().status == status


@pytest.mark.parametrize(
    "as_of, status", [("2024-01-02 12:00:00", "PASS"), ("2024-01-02 12:00:01", "FAIL")]
)
def test_freshness_limit(spark, as_of, status):
    df = spark.sql("SELECT 'x' AS ingestion_date, TIMESTAMP'2024-01-01 12:00:00' AS loaded")
    assert freshness_check(df, "t", as_of).first().status == status


def test_freshness_without_column_or_value(spark):
    plain = spark.range(2).toDF("v")
    assert freshness_check(plain, "t", "2024-01-01").first().status == "SKIP"
    assert freshness_check(plain, "t", "2024-01-01", no_column="PASS").first().status == "PASS"
    null = spark.sql("SELECT CAST(NULL AS TIMESTAMP) AS at")
    assert freshness_check(null, "t", "2024-01-01").first().status == "SKIP"
    row = freshness_check(null, "t", "2024-01-01", no_value="FAIL").first()
    assert (row.status, row.message) == ("FAIL", "No valid timestamps found")


def test_castable(spark):
    df = spark.createDataFrame([("1",), ("x",), (None,), ("2.5",)], "v string")
    assert castable_checks(df, "t", {"v": "int"}).first().violations == 2
    assert castable_checks(df, "t", {"v": "double"}).first().violations == 1


def test_quarantine_splits_the_table(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (2, None), (None, None)], "k int, v string")
    accepted, rejected = split_quarantine(df, ["k", "v"])
    assert [tuple(r) for r in accepted.collect()] == [(1, "a")]
    assert {r.null_columns for r in rejected.collect()} == {"k", "v", "k, v"}


def results(spark, rows):
    return spark.createDataFrame(rows, "table_name string, check_type string, status string")


def test_precedence_of_statuses(spark):
    checks = results(spark, [("t", "volume", "FAIL"), ("t", "nulls", "ERROR"), ("u", "volume", "PASS")])
    first = {r.table_name: r.overall_status for r in rollup.rollup_tables(checks).collect()}
    other = rollup.rollup_tables(checks, rollup.ERROR_FIRST)
    second = {r.table_name: r.overall_status for r in other.collect()}
    assert first == {"t": "FAIL", "u": "PASS"} and second == {"t": "ERROR", "u": "PASS"}


def test_skipped_check_leaves_the_table_passing(spark):
    checks = rollup.rollup_checks(results(spark, [("t", "fresh", "SKIP"), ("t", "volume", "PASS")]))
    assert {r.check_type: r.status for r in checks.collect()} == {"fresh": "SKIP", "volume": "PASS"}
    assert rollup.rollup_tables(checks).first().overall_status == "PASS"


def test_run_totals_of_no_tables(spark):
    totals = rollup.rollup_run(rollup.rollup_tables(results(spark, [])))
    assert totals.first().asDict() == {
        "total_tables": 0,
        "successful_checks": 0,
        "failed_checks": 0,
        "error_checks": 0,
    }


def test_consecutive_failures(spark):
    statuses = "FFPFFFPFFFF"
    rows = [
        ("t", "volume", "FAIL" if s == "F" else "PASS", f"run{i:02d}") for i, s in enumerate(statuses)
    ]
    history = spark.createDataFrame(
        rows, "table_name string, check_type string, status string, run_id string"
    )
    found = {(r.first_run, r.last_run, r.failures) for r in rollup.consecutive_failures(history).collect()}
    assert found == {("run03", "run05", 3), ("run07", "run10", 4)}


def test_retention_keeps_the_limit_day(spark):
    days = spark.sql("SELECT explode(sequence(DATE'2024-01-01', DATE'2024-02-29')) AS run_date")
    kept = rollup.retained(days, "run_date", "2024-02-29", 30)
    assert str(kept.agg({"run_date": "min"}).first()[0]) == "2024-01-30"


def test_rules_can_be_switched_off():
    config = {
        "data_sources": {"s": {"tables": {"t": {"primary_key": "id", "volume_min": 5}}}},
        "dq_rules": {
            "volume": {"max_records": 9},
            "null_checks": {"enabled": False, "critical_columns": ["id"]},
            "range_checks": {"numeric_ranges": {"v": {"min": 0, "max": 1}}},
            "freshness": {"max_age_hours": 12},
        },
    }
    rule = parse_rules(config)["t"]
    assert rule.volume == Range(5, 9) and rule.critical == () and rule.ranges == {"v": Range(0, 1)}
    assert rule.primary_key == ("id",) and rule.freshness_hours == 12


def test_rules_are_evaluated_per_run(spark):
    rows = [("a", 1, 5.0), ("a", 2, 50.0), ("b", None, 5.0)]
    df = spark.createDataFrame(rows, "run string, id int, v double")
    rule = TableRules(
        volume=Range(2, 9),
        critical=("id", "absent"),
        ranges={"v": Range(0, 10), "absent": Range(0, 1)},
        range_tolerance_pct=50.0,
        primary_key=("id",),
    )
    rows = evaluate_rules({"t": df}, {"t": rule}, by="run").collect()
    skipped = {(r.run_id, r.check_type, r.column_name) for r in rows if r.status == "SKIP"}
    assert skipped == {(run, c, "absent") for run in "ab" for c in ("null_checks", "range_checks")}
    found = {(r.run_id, r.check_type): (r.status, r.actual) for r in rows if r.status != "SKIP"}
    assert found == {
        ("a", "volume"): ("PASS", 2.0),
        ("b", "volume"): ("FAIL", 1.0),
        ("a", "null_checks"): ("PASS", 0.0),
        ("b", "null_checks"): ("FAIL", 100.0),
        ("a", "range_checks"): ("PASS", 50.0),
        ("b", "range_checks"): ("PASS", 0.0),
    }


def test_rules_of_an_empty_table(spark):
    df = spark.createDataFrame([], "id int, at timestamp")
    rule = TableRules(Range(0, 1), ("id",), primary_key=("id",), timestamp_column="at")
    found = {r.check_type: r.status for r in evaluate_rules({"t": df}, {"t": rule}, "2024-01-01").collect()}
    assert found == {"volume": "PASS", "null_checks": "PASS", "freshness": "SKIP", "primary_key": "PASS"}


def test_map_column_is_noted(spark):
    df = spark.sql("SELECT map('a', 1) AS m")
    alerts = column_findings(column_profile(df, "t")).where("record = 'alert'").collect()
    assert [(a.check_type, a.severity) for a in alerts] == [("distinctness", "INFO")]
