from pyspark.sql import functions as F

from plumbline.__main__ import main
from plumbline.operators.snapshot import snapshot_summary
from plumbline.plans.simulate import write_snapshots

DAY = "2024-01-10"


def source(spark, tmp_path, rows=3000):
    path = str(tmp_path / "loans")
    spark.range(rows).withColumn("AMT_BALANCE", F.lit(100.0)).write.parquet(path)
    return path


def by_day(spark, out):
    stored = spark.read.parquet(out)
    return {str(r.ingestion_date): r["count"] for r in stored.groupBy("ingestion_date").count().collect()}


def test_repeated_day_is_stored_once(spark, tmp_path):
    refs, keys, out = {"loans": source(spark, tmp_path)}, {"loans": "id"}, str(tmp_path / "out")
    widths = {"loans": {"AMT_BALANCE": 0.15}}
    for _ in range(2):
        results = write_snapshots(spark, refs, keys, DAY, out, {"loans": 0.1}, widths)
    row = results.first()
    assert (row.table_name, row.status) == ("loans_daily", "success") and 200 < row.record_count < 400
    assert by_day(spark, f"{out}/loans_daily") == {DAY: row.record_count}
    stored = spark.read.parquet(f"{out}/loans_daily")
    assert 92.5 <= stored.agg(F.min("AMT_BALANCE")).first()[0] < 100.0
    assert stored.first().batch_id == f"loans_batch_{DAY}"


def test_failed_source_does_not_stop_the_run(spark, tmp_path):
    refs = {"gone": str(tmp_path / "gone"), "loans": source(spark, tmp_path)}
    keys = {"gone": "id", "loans": "id"}
    results = write_snapshots(spark, refs, keys, DAY, str(tmp_path / "out"))
    found = {r.table_name: (r.status, r.message) for r in results.collect()}
    assert found == {"gone_daily": ("error", "PATH_NOT_FOUND"), "loans_daily": ("success", None)}
    row = snapshot_summary(results).first()
    assert (row.successful_tables, row.total_tables, row.success_rate) == (1, 2, 50.0)


def test_days_before_the_date(spark, tmp_path):
    refs, out = {"loans": source(spark, tmp_path)}, str(tmp_path / "out")
    results = write_snapshots(spark, refs, {"loans": "id"}, DAY, out, {"loans": 0.05}, days=3)
    stored = by_day(spark, f"{out}/loans_daily")
    assert sorted(stored) == ["2024-01-07", "2024-01-08", "2024-01-09"]
    assert results.first().record_count == sum(stored.values())


def test_command_line(spark, tmp_path, capsys):
    ref, out = source(spark, tmp_path), str(tmp_path / "out")
    main(
        ["snapshot", f"loans={ref}", "--key", "loans=id", "--rate", "loans=0.1", "--jitter"]
        + ["loans=credit_card", "--date", DAY, "--out", out]
    )
    assert "success" in capsys.readouterr().out and list(by_day(spark, f"{out}/loans_daily")) == [DAY]


def test_sample_without_rows_is_a_success(spark, tmp_path):
    refs, out = {"loans": source(spark, tmp_path)}, str(tmp_path / "out")
    for days in (None, 2):
        row = write_snapshots(spark, refs, {"loans": "id"}, DAY, out, {"loans": 0.0}, days=days).first()
        assert (row.status, row.record_count) == ("success", 0)
