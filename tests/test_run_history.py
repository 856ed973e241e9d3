"""Alerts over stored runs, retention, chosen pairs and policies."""

import json
import os

from plumbline.__main__ import main
from plumbline.operators.report import issue_texts
from plumbline.plans.checking import drop_old_runs, run_checks, stored_results
from plumbline.plans.policy import Policy, Range, RunSettings, TableRules
from plumbline.plans.rules import parse_settings

RUNS = [f"2024010{i}_000000" for i in range(1, 5)]


def test_settings_of_a_configuration():
    assert parse_settings({}) == RunSettings()
    config = {
        "monitoring": {"alert_threshold": {"failed_checks_percentage": 10, "consecutive_failures": 2}},
        "reporting": {"retention_days": 7},
    }
    assert parse_settings(config) == RunSettings(10.0, 2, 7)


def test_alerts_and_retention_of_stored_runs(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "t"))
    out, refs = str(tmp_path / "out"), {"t": str(tmp_path / "t")}
    rules = {"t": TableRules(volume=Range(10, 20), critical=("id",), ranges={"id": Range(0, 5)}, freshness_hours=None)}
    for run in RUNS[:3]:
        paths = run_checks(spark, refs, rules, out, run, "2024-01-04 00:00:00", settings=RunSettings(30.0, 3))
    found = {(r["alert"], r["table_name"], r["check_type"]): r["value"] for r in spark.read.json(paths["alerts"]).collect()}
    assert found.keys() == {("failed_checks", None, None), ("consecutive_failures", "t", "volume")}
    assert found["consecutive_failures", "t", "volume"] == 3
    told = {r["check_type"]: r["message"] for r in stored_results(spark, out).where(f"run_id = '{RUNS[0]}'").collect()}
    assert told["null_checks"] is None and told["volume"] == "volume is 3.0 against 10..20"
    old = drop_old_runs(spark, out, "2024-01-04", 1)
    assert {os.path.basename(r["path"]) for r in old.collect()} == {f"run_id={r}" for r in RUNS[:2]}
    assert not any(r["dropped"] for r in old.collect()) and os.path.isdir(f"{out}/results/run_id={RUNS[0]}")
    assert all(r["dropped"] for r in drop_old_runs(spark, out, "2024-01-04", 1, dry_run=False).collect())
    assert os.listdir(f"{out}/results") == [f"run_id={RUNS[2]}"]
    assert drop_old_runs(spark, out, "2024-01-04", 1).count() == 0


def test_policy_and_chosen_pair_on_the_command_line(spark, tmp_path):
    spark.createDataFrame([(1, "a"), (1, "b")], "user_key int, name string").write.parquet(str(tmp_path / "t"))
    (tmp_path / "policy.json").write_text(json.dumps({"id_pattern": "key$"}))
    out = str(tmp_path / "out")
    for day in ("2024-01-01", "2024-01-02", "2024-01-03"):
        main(["daily", f"t={tmp_path / 't'}", "--out", out, "--date", day, "--policy", str(tmp_path / "policy.json")])
    runs = sorted(d.split("=")[1] for d in os.listdir(f"{out}/documents"))
    findings = spark.read.parquet(f"{out}/findings/run_id={runs[0]}").where("column_name = 'user_key'").collect()
    assert "id_uniqueness" in {r["check_type"] for r in findings}
    main(["drift", "--out", out, "--runs", runs[0], runs[2]])
    found = spark.read.json(f"{out}/drift/*").select("old_run", "new_run").distinct().collect()
    assert [tuple(r) for r in found] == [(runs[0], runs[2])]
    main(["retain", "--out", out, "--date", "2024-01-03", "--days", "1", "--drop"])
    assert sorted(d.split("=")[1] for d in os.listdir(f"{out}/documents")) == runs[1:]


def test_outliers_are_an_issue(spark):
    rows = spark.createDataFrame([("AMT_X", 2, 1, 3), ("v", 0, 0, 0)], "column_name string, negative_count int, blank_count int, outlier_count int")
    texts = [r[0] for r in rows.select(issue_texts(Policy(), outliers=True)).collect()]
    assert texts == ["3 potential outliers detected; 2 negative values; 1 empty strings", ""]
