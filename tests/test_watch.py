import datetime
import json

import pytest

from plumbline.__main__ import main
from plumbline.plans.policy import Range, TableRules
from plumbline.plans.rules import compile_checks, evaluate_rules
from plumbline.streaming import watch
from plumbline.streaming.watch import buffers, judged

SCHEMA = "id bigint, ts timestamp_ntz, value double, kind string"
RULE = TableRules(
    volume=Range(2, 30),
    critical=("id",),
    ranges={"value": Range(0, 10)},
    patterns={"kind": "^[a-z]$"},
    types={"kind": "int"},
    primary_key=("id",),
    freshness_hours=None,
)


def at(day, hour=5):
    return datetime.datetime(2024, 1, day, hour)


def add(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(str(folder))


def rows_of(found):
    return {(str(r.day), r.check_type): r for r in found.collect()}


def test_days_do_not_depend_on_batches(spark, tmp_path):
    rows = [(i, at(1 + i % 4), float(i % 13), "ab1"[i % 3]) for i in range(80)] + [(None, None, None, None)]
    for start in range(0, 81, 20):
        add(spark, tmp_path / "in", rows[start : start + 20])
    refs, rules = {"t": str(tmp_path / "in")}, {"t": RULE}
    split = watch(spark, refs, rules, str(tmp_path / "split"), 1000, files_a_batch=1)
    whole = watch(spark, refs, rules, str(tmp_path / "whole"), 1000)
    assert sorted(map(str, split.collect())) == sorted(map(str, whole.collect()))
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "to_date(ts) AS day")
    batch = evaluate_rules({"t": df}, {"t": RULE}, by="day").collect()
    want = {(str(r.run_id), r.check_type, r.column_name): (r.status, r.actual, r.threshold) for r in batch}
    got = {
        (str(r.day), r.check_type, r.column_name): (r.status, r.actual, r.threshold)
        for r in split.collect()
        if r.check_type != "primary_key"
    }
    assert got == want and len(got) == 25


def test_late_rows_are_named_and_change_nothing(spark, tmp_path):
    refs, rules, out = {"t": str(tmp_path / "in")}, {"t": RULE}, str(tmp_path / "out")
    add(spark, tmp_path / "in", [(1, at(1), 1.0, "a"), (2, at(1), 2.0, "a")])
    first = rows_of(watch(spark, refs, rules, out, 24))
    assert not first["2024-01-01", "volume"].final
    add(spark, tmp_path / "in", [(3, at(3), 1.0, "a"), (4, at(1), 1.0, "b")])
    second = rows_of(watch(spark, refs, rules, out, 24))
    # The second batch made the day final: its own row was still in time.
    assert second["2024-01-01", "volume"].final and second["2024-01-01", "volume"].actual == 3
    add(spark, tmp_path / "in", [(5, at(1), 99.0, "late"), (6, at(3), 1.0, "a")])
    third = rows_of(watch(spark, refs, rules, out, 24))
    assert (third["2024-01-01", "volume"].actual, third["2024-01-01", "volume"].late_rows) == (3, 1)
    assert third["2024-01-01", "range_checks"].status == "PASS"
    assert third["2024-01-03", "volume"].actual == 2 and not third["2024-01-03", "volume"].final
    (late,) = spark.read.parquet(f"{out}/t/late").collect()
    assert (late.id, late.value, late.batch) == (5, 99.0, 2)


def test_repeated_keys_are_estimated_within_the_stated_error(spark):
    df = spark.range(40_000).selectExpr(
        "id % 30000 AS id", "TIMESTAMP_NTZ '2024-01-01 05:00:00' AS ts", "1D AS value", "'a' AS kind"
    )
    checks = compile_checks(df, RULE, None)
    (half, other) = (buffers(df.where(f"id % 2 = {k}"), RULE) for k in (0, 1))
    row = rows_of(judged(half.unionByName(other), "t", checks))["2024-01-01", "primary_key"]
    assert row.status == "FAIL" and abs(row.actual - 25) < 75 * 3 * 1.04 / 64
    unique = buffers(df.where("id < 10000").dropDuplicates(["id"]), RULE)
    assert rows_of(judged(unique, "t", checks))["2024-01-01", "primary_key"].status == "PASS"


def test_a_rule_that_came_later_skips_earlier_days(spark, tmp_path):
    refs, out = {"t": str(tmp_path / "in")}, str(tmp_path / "out")
    add(spark, tmp_path / "in", [(1, at(1), 1.0, "a")])
    few = TableRules(volume=Range(1, 9), freshness_hours=None)
    assert set(rows_of(watch(spark, refs, {"t": few}, out, 24))) == {("2024-01-01", "volume")}
    add(spark, tmp_path / "in", [(1, at(2), None, "a")])
    found = rows_of(watch(spark, refs, {"t": RULE}, out, 24))
    assert found["2024-01-01", "range_checks"].status == "SKIP"
    assert found["2024-01-02", "range_checks"].status == "PASS"


def test_a_broken_table_stops_no_other(spark, tmp_path):
    add(spark, tmp_path / "in", [(1, at(1), 1.0, "a")])
    spark.range(3).write.parquet(str(tmp_path / "dateless"))
    refs = {"t": str(tmp_path / "in"), "gone": str(tmp_path / "gone"), "dateless": str(tmp_path / "dateless")}
    found = watch(spark, refs, dict.fromkeys(refs, RULE), str(tmp_path / "out")).collect()
    errors = {r.table_name: r.threshold for r in found if r.status == "ERROR"}
    assert errors == {"gone": "PATH_NOT_FOUND", "dateless": "NothingToDo"}
    assert {r.check_type for r in found if r.table_name == "t"} > {"volume", "pattern"}


def test_command_line(spark, tmp_path, capsys):
    add(spark, tmp_path / "in", [(1, at(1), 1.0, "a"), (2, at(2), 1.0, "a")])
    rules = tmp_path / "rules.json"
    rules.write_text(
        json.dumps({"data_sources": {"s": {"tables": {"t": {"volume_min": 1}}}}, "dq_rules": {"volume": {"max_records": 1}}})
    )
    arguments = ["monitor", f"t={tmp_path / 'in'}", "--rules", str(rules), "--out", str(tmp_path / "out"), "--delay-hours", "1"]
    main(arguments)
    add(spark, tmp_path / "in", [(3, at(2), 1.0, "a")])
    main(arguments)
    path = capsys.readouterr().out.splitlines()[-1].split(": ", 1)[1]
    found = {r.day: r.status for r in spark.read.json(path).collect()}
    assert found == {"2024-01-01": "PASS", "2024-01-02": "FAIL"}
