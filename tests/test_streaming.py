import datetime

from plumbline.plans.policy import Range
from plumbline.streaming import daily_figures, judge_days, monitor_arrivals

SCHEMA = "ts timestamp_ntz, value double"


def add(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def test_arrivals_add_up_over_batches(spark, tmp_path):
    folder, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    one, two = datetime.datetime(2024, 1, 1, 5), datetime.datetime(2024, 1, 2, 5)
    add(spark, folder, [(one, 1.0), (one, None), (two, 99.0)])

    def monitor():
        stream = spark.readStream.schema(SCHEMA).parquet(folder)
        return monitor_arrivals(stream, out, state, "ts", "value", Range(0, 10))

    first = {str(r.day): r for r in judge_days(monitor(), Range(2, 3), 5.0).collect()}
    assert (first["2024-01-01"].record_count, first["2024-01-01"].null_status) == (2, "FAIL")
    assert (first["2024-01-02"].volume_status, first["2024-01-02"].range_status) == ("FAIL", "FAIL")

    add(spark, folder, [(two, 3.0)])
    second = {str(r.day): r for r in judge_days(monitor(), Range(2, 3), 50.0).collect()}
    assert (second["2024-01-02"].record_count, second["2024-01-02"].min_value) == (2, 3.0)
    assert (second["2024-01-02"].volume_status, second["2024-01-02"].range_status) == ("PASS", "PASS")
    # Nothing new: the figures stay.
    assert judge_days(monitor(), Range(2, 3)).count() == 2


def test_nothing_has_arrived(spark, tmp_path):
    (tmp_path / "in").mkdir()
    stream = spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "in"))
    figures = monitor_arrivals(
        stream, str(tmp_path / "out"), str(tmp_path / "state"), "ts", "value", Range(0, 1)
    )
    assert figures.count() == 0


def test_batch_equals_stream(spark, tmp_path):
    rows = [(datetime.datetime(2024, 1, 1 + i % 3, 1), float(i)) for i in range(50)]
    folder = str(tmp_path / "in")
    for start in range(0, 50, 10):
        add(spark, folder, rows[start : start + 10])
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 2).parquet(folder)
    figures = monitor_arrivals(
        stream, str(tmp_path / "out"), str(tmp_path / "state"), "ts", "value", Range(0, 40)
    )
    assert figures.select("batch").distinct().count() == 3
    whole = daily_figures(spark.createDataFrame(rows, SCHEMA), "ts", "value", Range(0, 40))
    streamed = judge_days(figures, Range(0, 100))
    assert sorted(map(tuple, streamed.collect())) == sorted(
        map(tuple, judge_days(whole, Range(0, 100)).collect())
    )
