import json

from pyspark.sql import functions as F

from plumbline.__main__ import main
from plumbline.operators.rollup import ERROR_FIRST, change_points
from plumbline.plans.checking import run_checks, stored_run
from plumbline.plans.policy import LOAN_VOLUMES, Range, TableRules, loan_rules, strict_loan_rules


def loans(spark, folder, rows, **columns):
    df = spark.range(rows).withColumnRenamed("id", "SK_ID_CURR")
    for name, value in columns.items():
        df = df.withColumn(name, value)
    df.write.parquet(str(folder))
    return str(folder)


def csv_rows(spark, path):
    return spark.read.option("header", True).csv(path).collect()


def test_tolerant_and_strict_rules(spark, tmp_path):
    train = loans(
        spark,
        tmp_path / "train",
        2000,
        TARGET=F.lit(1),
        AMT_CREDIT=F.when(F.col("SK_ID_CURR") < 10, -1.0).otherwise(5.0),
        AMT_INCOME_TOTAL=F.when(F.col("SK_ID_CURR") >= 300, 1.0),
        ingestion_timestamp=F.lit("2024-01-01 00:00:00").cast("timestamp"),
    )
    refs = {"application_train_daily": train}
    runs = {"tolerant": loan_rules(), "strict": strict_loan_rules()}
    found = {}
    for name, rules in runs.items():
        paths = run_checks(spark, refs, rules, str(tmp_path / name), "1", "2024-01-01 20:00:00")
        found[name] = {
            (r.table_name, r.check_type): r.status for r in csv_rows(spark, paths["checks"])
        }
        statuses = {r.table_name: r.overall_status for r in csv_rows(spark, paths["tables"])}
        assert set(statuses) == set(LOAN_VOLUMES)
        assert sorted(statuses.values()).count("SKIPPED") == 7
    t = "application_train_daily"
    # 15 % of the incomes are null: fine for a watched column, too much for a critical one.
    assert (found["tolerant"][t, "null_checks"], found["strict"][t, "null_checks"]) == ("PASS", "FAIL")
    assert (found["tolerant"][t, "range_checks"], found["strict"][t, "range_checks"]) == ("PASS", "FAIL")
    assert found["tolerant"][t, "freshness"] == found["strict"][t, "freshness"] == "PASS"


def test_table_without_time_stamps(spark, tmp_path):
    ref = loans(spark, tmp_path / "t", 3)
    for status in ("SKIP", "PASS"):
        rule = TableRules(no_timestamp_status=status)
        paths = run_checks(spark, {"t": ref}, {"t": rule}, str(tmp_path / status), "1", "2024-01-01")
        (row,) = csv_rows(spark, paths["checks"])
        assert (row.check_type, row.status) == ("freshness", status)


def test_table_that_cannot_be_judged_is_an_error(spark, tmp_path):
    good = loans(spark, tmp_path / "good", 5)
    bad = loans(spark, tmp_path / "bad", 5, word=F.lit("abc"))
    rules = {
        "good": TableRules(Range(1, 4), freshness_hours=None),
        "bad": TableRules(Range(1, 9), ranges={"word": Range(0, 1)}, freshness_hours=None),
    }
    paths = run_checks(spark, {"good": good, "bad": bad}, rules, str(tmp_path / "o"), "1", "2024-01-01", ERROR_FIRST)
    assert {r.table_name: r.overall_status for r in csv_rows(spark, paths["tables"])} == {
        "good": "FAIL",
        "bad": "ERROR",
    }
    run = spark.read.json(paths["run"]).first()
    assert (run.total_tables, run.failed_checks, run.error_checks) == (2, 1, 1)
    rows = spark.read.parquet(f"{paths['results']}/source=bad").collect()
    assert [(r.check_type, r.status) for r in rows] == [("volume", "PASS")]
    found = {(r.table_name, r.column_name, r.check_type): (r.status, r.message) for r in stored_run(spark, paths).collect()}
    assert found["bad", "word", "range_checks"] == ("ERROR", "CAST_INVALID_INPUT")
    lines = [r.value for r in spark.read.text(paths["summary"]).collect()]
    assert lines[1] == "DATA QUALITY REPORT" and "Failed: 1" in lines and "Errors: 1" in lines
    place = lines.index("TABLE: bad")
    assert lines[place : place + 5] == [
        "TABLE: bad",
        "-" * 60,
        "   Overall Status: ERROR",
        "   range_checks word: ERROR",
        "   volume: PASS - 5.00 against 1..9",
    ]


def test_rules_alone_name_the_tables(spark, tmp_path, capsys):
    ref = loans(spark, tmp_path / "t", 5, ts=F.lit("2024-01-01 00:00:00").cast("timestamp"))
    config = tmp_path / "rules.json"
    tables = {"t": {"path": ref, "volume_min": 1, "timestamp_column": "ts"}}
    config.write_text(
        json.dumps(
            {
                "data_sources": {"s": {"tables": tables}},
                "dq_rules": {"volume": {"max_records": 9}, "freshness": {"max_age_hours": 24}},
                "reporting": {"retention_days": 7},
            }
        )
    )
    out = tmp_path / "out"
    main(["check", "--rules", str(config), "--out", str(out), "--as-of", "2024-01-02 06:00:00"])
    printed = dict(line.split(": ", 1) for line in capsys.readouterr().out.splitlines())
    assert {r.table_name: r.overall_status for r in csv_rows(spark, printed["tables"])} == {"t": "FAIL"}
    fresh = stored_run(spark, printed).where("check_type = 'freshness'").first()
    assert (fresh.latest, fresh.actual, fresh.status) == ("2024-01-01 00:00:00", 30.0, "FAIL")
    # Runs of more than seven days ago go, as the rules say.
    for day in ("20240101", "20240110"):
        (out / "results" / f"run_id={day}_000000").mkdir()
    main(["retain", "--out", str(out), "--rules", str(config), "--date", "2024-01-12", "--drop"])
    left = {p.name for p in (out / "results").iterdir()}
    assert "run_id=20240101_000000" not in left and "run_id=20240110_000000" in left


def test_volume_is_held_against_earlier_weeks(spark, tmp_path):
    rules = {"t": TableRules(volume=Range(0, 10_000), freshness_hours=None)}
    found = []
    for week, rows in enumerate((100, 102, 98, 101, 40)):
        ref = loans(spark, tmp_path / f"t{week}", rows)
        day = f"2024{['0101', '0108', '0115', '0122', '0129'][week]}"
        paths = run_checks(spark, {"t": ref}, rules, str(tmp_path / "out"), f"{day}_000000", "2024-01-01")
        row = spark.read.schema("expected_count double, status string").json(paths["expected"]).first()
        found.append((row.expected_count, row.status))
    assert found == [(None, "SKIP")] * 3 + [(100.0, "PASS"), (100.5, "FAIL")]


def test_a_planted_step_is_found_on_its_day(spark):
    scores = [(f"d{i:02}", 95.0 + (i % 3) / 4 - (12 if i >= 30 else 0)) for i in range(60)]
    frame = spark.createDataFrame([("t", d, s) for d, s in scores] + [("even", d, 90.0) for d, _ in scores], "table_name string, run_id string, mean_score double")
    found = change_points(frame).where("changed").collect()
    assert [(r.table_name, r.run_id) for r in found] == [("t", "d30")]
    assert change_points(frame.limit(0)).count() == 0


def test_command_line(spark, tmp_path, capsys):
    ref = loans(spark, tmp_path / "t", 5)
    config = tmp_path / "rules.json"
    config.write_text(
        json.dumps(
            {
                "data_sources": {"s": {"tables": {"t": {"volume_min": 1}, "gone": {}}}},
                "dq_rules": {"volume": {"max_records": 9}},
            }
        )
    )
    main(["check", f"t={ref}", "--rules", str(config), "--out", str(tmp_path / "out")])
    printed = dict(line.split(": ", 1) for line in capsys.readouterr().out.splitlines())
    statuses = {r.table_name: r.overall_status for r in csv_rows(spark, printed["tables"])}
    assert statuses == {"t": "PASS", "gone": "SKIPPED"}
