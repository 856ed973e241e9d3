"""Scores against worked examples."""

import pytest
from pyspark.sql import functions as F

from plumbline.operators.checks import column_findings, literal_rows, with_findings
from plumbline.operators.profile import PROFILE_FIELDS
from plumbline.operators.scoring import score_alerts, score_band, score_issues, score_nulls, score_signs

_TYPES = {
    "table_name": "string",
    "column_name": "string",
    "ordinal": "int",
    "data_type": "string",
    "kind": "string",
    "min_len": "int",
    "max_len": "int",
}
_DOUBLES = {
    "null_pct",
    "uniqueness_pct",
    "min_num",
    "max_num",
    "mean",
    "range_span",
    "stddev",
    "avg_len",
}


def profile_row(spark, name, nulls, rows, **fields):
    values = {
        "table_name": "t",
        "column_name": name,
        "kind": "numeric",
        "total_rows": rows,
        "null_count": nulls,
        "non_null_count": rows - nulls,
        "null_pct": nulls / rows * 100 if rows else 0.0,
    } | fields
    schema = ", ".join(
        f"{f} {_TYPES.get(f, 'double' if f in _DOUBLES else 'bigint')}" for f in PROFILE_FIELDS
    )
    return literal_rows(spark, [tuple(values.get(f) for f in PROFILE_FIELDS)], schema)


@pytest.mark.parametrize(
    "name, nulls, rows, fields, score",
    [
        ("OWN_CAR_AGE", 2137, 3200, {}, 50.0),
        ("OCCUPATION_TYPE", 1014, 3200, {"kind": "string", "distinct_count": 19}, 68.3),
        ("EMERGENCYSTATE_MODE", 1506, 3200, {"kind": "string", "distinct_count": 3}, 52.9),
        ("DAYS_ENDDATE_FACT", 6346, 17272, {}, 63.3),
        ("AMT_CREDIT_SUM_DEBT", 2632, 17272, {"negative_count": 74}, 74.8),
        ("AMT_CREDIT_SUM_LIMIT", 6010, 17272, {"negative_count": 3}, 55.2),
        ("AMT_BALANCE", 0, 38749, {"negative_count": 17}, 90.0),
        ("RATE_INTEREST_PRIMARY", 16761, 16820, {}, 50.0),
        ("SK_ID_CURR", 0, 3200, {"uniqueness_pct": 100.0}, 100.0),
        ("SK_ID_CURR", 320, 3200, {"uniqueness_pct": 99.0}, 100.0),
        ("NAME", 0, 100, {"kind": "string", "blank_count": 4}, 95.0),
        ("DAYS_BIRTH", 0, 100, {"negative_count": 100}, 100.0),
    ],
)
def test_score_by_signs(spark, name, nulls, rows, fields, score):
    profile = profile_row(spark, name, nulls, rows, **fields)
    assert score_signs(profile).first().data_quality_score == score


@pytest.mark.parametrize("nulls, rows, score", [(3663, 10000, 63.4), (2247, 10000, 77.5), (0, 5, 100.0)])
def test_score_by_nulls(spark, nulls, rows, score):
    assert score_nulls(profile_row(spark, "c", nulls, rows)).first().data_quality_score == score


@pytest.mark.parametrize(
    "name, nulls, rows, fields, score",
    [
        ("c", 0, 100, {}, 100.0),
        ("c", 25, 100, {}, 87.5),
        ("c", 50, 100, {}, 75.0),
        ("c", 51, 100, {}, 45.0),
        ("c", 95, 100, {}, 45.0),
        ("c", 96, 100, {}, 25.0),
        ("SK_ID_CURR", 0, 100, {"uniqueness_pct": 80.0}, 70.0),
        ("SK_ID_CURR", 0, 100, {"uniqueness_pct": 95.0}, 100.0),
        ("MY_DAYS_X", 0, 100, {"min_num": -1.0, "max_num": 365243.0, "range_span": 365244.0}, 90.0),
        ("AMT_X", 0, 100, {"min_num": -1.0, "max_num": 1.0, "range_span": 2.0}, 90.0),
        ("TARGET", 0, 100, {"min_num": 0.0, "max_num": 2.0, "range_span": 2.0}, 100.0),
        ("c", 0, 100, {"min_num": 3.0, "max_num": 3.0, "range_span": 0.0}, 100.0),
        ("c", 0, 100, {"kind": "string", "min_len": 0, "max_len": 500}, 90.0),
        ("c", 0, 0, {}, 0.0),
    ],
)
def test_score_by_alerts(spark, name, nulls, rows, fields, score):
    assessed = score_alerts(with_findings(profile_row(spark, name, nulls, rows, **fields)))
    assert assessed.first().data_quality_score == score


def test_score_by_issues(spark):
    profile = profile_row(spark, "AMT_X", 10, 100, negative_count=5)
    far = literal_rows(
        spark, [("t", "AMT_X", 3)], "table_name string, column_name string, outlier_count bigint"
    )
    assert score_issues(profile, far).first().data_quality_score == 70.0
    none = far.where("outlier_count = 0")
    assert score_issues(profile, none).first().data_quality_score == 80.0


def test_outside_zero_and_one_is_an_error_without_cost(spark):
    profile = profile_row(spark, "TARGET", 0, 10, min_num=-1.0, max_num=1.0, range_span=2.0)
    alerts = column_findings(profile).where("record = 'alert'").collect()
    assert [(a.check_type, a.severity, a.actual) for a in alerts] == [("binary_domain", "ERROR", -1.0)]


def test_empty_table_gives_one_alert_and_no_check(spark):
    found = column_findings(profile_row(spark, "SK_ID_X", 0, 0)).collect()
    assert [(f.check_type, f.severity) for f in found] == [("empty_table", "CRITICAL")]


def test_severity_does_not_come_from_the_name(spark):
    profile = profile_row(spark, "WARNING_CRITICAL_DAYS", 0, 10, min_num=1.0, max_num=1.0, range_span=0.0)
    assert score_alerts(with_findings(profile)).first().data_quality_score == 100.0


@pytest.mark.parametrize(
    "score, band", [(100.0, "good"), (80.0, "good"), (79.9, "warning"), (60.0, "warning"), (59.9, "error")]
)
def test_bands(spark, score, band):
    assert spark.range(1).select(score_band(F.lit(score)).alias("b")).first().b == band
