import json

from plumbline.__main__ import main
from plumbline.functions.frames import NothingToDo
from plumbline.functions.jobs import bisected
from plumbline.plans.daily import assess, batch_drift, run_daily, take_snapshots, window_profile
from plumbline.sources import load_each

SF_DIR = "/root/testdata/sf0.001"


def tables(spark):
    return {t: spark.read.parquet(f"{SF_DIR}/{t}.parquet") for t in ("customer", "part")}


def test_two_runs_and_their_drift(spark, tmp_path):
    out = str(tmp_path)
    whole = tables(spark)
    run_daily(whole, out, "20240101_000000", "2024-01-01T00:00:00")
    less = {name: df.where(f"{df.columns[0]} > 10") for name, df in whole.items()}
    paths = run_daily(less, out, "20240102_000000", "2024-01-02T00:00:00")
    drift = batch_drift(spark, out)
    row = drift.where("table_name = 'part' AND column_name = 'p_partkey' AND stat = 'total_rows'").first()
    assert (row.old_run, row.new_run) == ("20240101_000000", "20240102_000000")
    assert row.new_value == less["part"].count() and row.percent_change < 0
    lines = [r.value for r in spark.read.text(paths["summary"]).collect()]
    assert lines[2:4] == ["Generated: 2024-01-02T00:00:00", "Simulation ID: 20240102_000000"]
    assert lines[4] == "Total Tables: 2"
    metrics = spark.read.json(paths["metrics"]).first()
    assert metrics.columns_analyzed == 11 and metrics.execution_time_seconds > 0


def test_failed_column_becomes_an_error_row(spark, tmp_path):
    good = tables(spark)
    # Two of the columns fail on their values.
    bad = good["part"].selectExpr("p_partkey", "CAST(p_name AS INT) AS broken", "p_brand", "p_size", "CAST(p_type AS DATE) AS odd")
    paths = run_daily({"customer": good["customer"], "part": bad}, str(tmp_path), "20240101_000000", "now")
    detail = spark.read.option("header", True).csv(paths["detail"])
    rows = {r.column_name: r for r in detail.where("table_name = 'part'").collect()}
    assert {c: r.issues for c, r in rows.items() if r.data_type is None} == {
        "broken": "CAST_INVALID_INPUT",
        "odd": "CAST_INVALID_INPUT",
    }
    assert rows["broken"].data_quality_score == "0.0" and rows["p_size"].data_type == "int"
    assessed = spark.read.parquet(paths["assessment"])
    places = assessed.where("table_name = 'part'").select("column_name", "ordinal").collect()
    assert {tuple(r) for r in places} == {("p_partkey", 0), ("p_brand", 2), ("p_size", 3)}
    assert detail.where("table_name = 'customer'").count() == 5
    found = spark.read.parquet(paths["findings"]).where("status = 'ERROR'").collect()
    assert {(r.table_name, r.column_name, r.check_type) for r in found} == {("part", c, "evaluation") for c in ("broken", "odd")}
    lines = [r.value for r in spark.read.text(paths["summary"]).collect()]
    assert "part: 200 rows, 3 columns" in lines


def test_a_table_without_a_good_column_and_a_missing_source(spark, tmp_path):
    bad = tables(spark)["part"].selectExpr("CAST(p_name AS INT) AS broken")
    refs = {"customer": f"{SF_DIR}/customer.parquet", "gone": str(tmp_path / "gone")}
    found, failed = load_each(spark, refs)
    paths = run_daily(found | {"part": bad}, str(tmp_path / "out"), "1", "now", failed=failed)
    detail = spark.read.option("header", True).csv(paths["detail"]).where("data_type IS NULL").collect()
    assert {(r.table_name, r.column_name, r.issues) for r in detail} == {
        ("part", "ERROR", "CAST_INVALID_INPUT"),
        ("gone", "ERROR", "PATH_NOT_FOUND"),
    }
    lines = [r.value for r in spark.read.text(paths["summary"]).collect()]
    assert "part: ERROR" in lines and "gone: ERROR" in lines and "Failed: 2" in lines


def test_what_fails_is_halved_until_it_is_alone():
    runs = []

    def job(part):
        runs.append(list(part))
        if set(part) & {3, 77}:
            raise NothingToDo("3 or 77")
        return len(part)

    found, errors = bisected(job, list(range(100)))
    assert sum(found) == 98 and errors == {3: "NothingToDo", 77: "NothingToDo"}
    assert len(runs) < 30
    assert bisected(job, [1, 2]) == ([2], {})


def test_same_day_gives_the_same_snapshot(spark):
    keys = {"customer": "c_custkey", "part": "p_partkey"}
    first, second = (
        take_snapshots(tables(spark), keys, "2024-01-01", "run", {"customer": 0.5, "part": 0.5}, "2024-01-01")
        for _ in range(2)
    )
    assert set(first) == {"customer_daily", "part_daily"}
    for name in first:
        assert first[name].drop("batch_id").exceptAll(second[name].drop("batch_id")).count() == 0


def test_scores_lie_between_0_and_100(spark):
    for row in assess(tables(spark)).collect():
        assert 0 <= row.data_quality_score <= 100


def test_command_line(spark, tmp_path, capsys):
    out = str(tmp_path)
    main(["daily", f"customer={SF_DIR}/customer.parquet", "--out", out, "--key", "customer=c_custkey"])
    main(["drift", "--out", out])
    (summary,) = (tmp_path / "summary").glob("run_id=*/part-*")
    text = summary.read_text()
    assert "Random Seed: " in text and "Simulation Date: " in text and "(seed: " in text
    main(["export", f"part={SF_DIR}/part.parquet", "--out", f"{out}/export"])
    assert "documents" in capsys.readouterr().out
    (document,) = (tmp_path / "documents").glob("run_id=*/*.json")
    found = json.loads(document.read_text().splitlines()[0])
    assert found["table_name"] == "customer_daily" and len(found["column_analysis"]) == 5


def test_runs_are_profiled_together_from_their_sketches(spark, tmp_path):
    out, part = str(tmp_path), tables(spark)["part"]
    for day, condition in (("20240101", "p_partkey <= 120"), ("20240102", "p_partkey > 80"), ("20240103", "p_partkey > 190")):
        run_daily({"part": part.where(condition)}, out, f"{day}_000000", "now", keep_sketches=True)
    found = {r.column_name: r for r in window_profile(spark, out, last_run="20240102_999999").collect()}
    assert found["p_partkey"].total_rows == 240 and abs(found["p_partkey"].distinct_count - 200) <= 10
    assert found["p_brand"].distinct_count == part.select("p_brand").distinct().count()
    assert (found["p_size"].min_num, found["p_size"].max_num) == tuple(part.selectExpr("min(p_size)", "max(p_size)").first())
