import math

import pytest
from pyspark.sql import functions as F

from plumbline.operators import drift
from plumbline.operators.profile import column_profile, profile_long

LONG = "run_id string, table_name string, column_name string, stat string, value double"


@pytest.mark.parametrize(
    "old, new, change",
    [
        (0.0, 0.0, None),
        (0.0, 5.0, math.inf),
        (0.0, -5.0, math.inf),
        (10.0, 15.0, 50.0),
        (10.0, 10.0, 0.0),
        (-10.0, -5.0, -50.0),
    ],
)
def test_percent_change(spark, old, new, change):
    found = spark.range(1).select(drift.percent_change(F.lit(old), F.lit(new)).alias("c")).first().c
    assert found == change


@pytest.mark.parametrize("change, sign", [(-1.0, "neg"), (0.0, "pos"), (math.inf, "pos"), (None, None)])
def test_sign(spark, change, sign):
    column = drift.change_sign(F.lit(change).cast("double"))
    assert spark.range(1).select(column.alias("s")).first().s == sign


def test_run_against_itself_has_no_change(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b")], "v int, s string")
    long = profile_long(column_profile(df, "t"))
    rows = drift.drift_pair(long, long).collect()
    assert rows and all(r.percent_change in (0.0, None) for r in rows)


def test_statistic_missing_in_a_run_has_no_partner(spark):
    rows = [(run, "t", "c", "mean", v) for run, v in (("r1", 1.0), ("r3", 3.0), ("r4", 6.0))]
    rows += [(run, "t", "c", "rows", 9.0) for run in ("r1", "r2", "r3", "r4")]
    found = drift.drift_consecutive(spark.createDataFrame(rows, LONG)).collect()
    means = [(r.old_run, r.new_run, r.percent_change) for r in found if r.stat == "mean"]
    assert means == [("r3", "r4", 100.0)]
    assert sorted((r.old_run, r.new_run) for r in found if r.stat == "rows") == [
        ("r1", "r2"),
        ("r2", "r3"),
        ("r3", "r4"),
    ]


def test_single_run_has_no_drift(spark):
    one = spark.createDataFrame([("r1", "t", "c", "mean", 1.0)], LONG)
    found = drift.drift_message(drift.drift_consecutive(one)).first()
    assert (found.compared, found.message) == (0, drift.NO_DRIFT)


def test_chosen_pair(spark):
    rows = [("r1", "t", "c", "mean", 4.0), ("r2", "t", "c", "mean", 9.0), ("r3", "t", "c", "mean", 5.0)]
    row = drift.drift_between(spark.createDataFrame(rows, LONG), "r1", "r3").first()
    assert (row.old_run, row.new_run, row.percent_change) == ("r1", "r3", 25.0)
