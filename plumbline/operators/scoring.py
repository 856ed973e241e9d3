"""Quality scores from 0 to 100 per column. The models differ; each is kept on its own."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.scalars import half_up
from plumbline.plans.policy import Policy

# Points of the scores.
CRITICAL_POINTS, WARNING_POINTS, FAILED_POINTS = 30, 10, 20
ISSUE_POINTS, ID_BONUS, NEGATIVE_POINTS, BLANK_POINTS = 10, 10, 10, 5
MAX_NULL_POINTS_HALVED, MAX_NULL_POINTS = 25.0, 50.0
ID_BONUS_ABOVE = 95.0
GOOD_FROM, FAIR_FROM = 80, 60


def _bounded(score: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(100.0), half_up(score, 1)))


def alert_score(null_pct: Column, critical: Column, warning: Column, failed: Column) -> Column:
    """Alerts and failed checks cost points, and nulls half their percentage up to 25."""
    lost = (
        critical * CRITICAL_POINTS
        + warning * WARNING_POINTS
        + failed * FAILED_POINTS
        + F.least(null_pct / 2, F.lit(MAX_NULL_POINTS_HALVED))
    )
    return F.greatest(half_up(F.lit(100.0) - lost, 1), F.lit(0.0))


def _id_bonus(policy: Policy) -> Column:
    unique = half_up(F.col("uniqueness_pct"), 2) > ID_BONUS_ABOVE
    return F.when(F.col("column_name").rlike(policy.id_pattern) & unique, ID_BONUS).otherwise(0)


def _null_points(null_pct: Column) -> Column:
    return F.least(null_pct, F.lit(MAX_NULL_POINTS))


def score_alerts(assessed: DataFrame) -> DataFrame:
    """Model A: alerts by severity, failed checks and nulls. A table without rows scores 0."""
    score = alert_score(
        F.col("null_pct"), F.col("critical_alerts"), F.col("warning_alerts"), F.col("failed_checks")
    )
    return assessed.withColumn(
        "data_quality_score", F.when(F.col("total_rows") == 0, 0.0).otherwise(score)
    )


def issue_count(policy: Policy) -> Column:
    """Issues of a column: outliers, negative amounts and blank strings."""
    amount = F.col("column_name").rlike(policy.amount_pattern)
    return (
        F.when(F.col("outlier_count") > 0, 1).otherwise(0)
        + F.when(amount & (F.col("negative_count") > 0), 1).otherwise(0)
        + F.when(F.col("blank_count") > 0, 1).otherwise(0)
    )


def score_issues(profile: DataFrame, outliers: DataFrame, policy: Policy = Policy()) -> DataFrame:
    """Model B: nulls up to 50 points, 10 per issue, 10 more for unique identifiers."""
    counted = outliers.select("table_name", "column_name", "outlier_count")
    scored = profile.join(counted, ["table_name", "column_name"], "left").withColumn(
        "issue_count", issue_count(policy)
    )
    points = (
        F.lit(100.0)
        - _null_points(F.col("null_pct"))
        - F.col("issue_count") * ISSUE_POINTS
        + _id_bonus(policy)
    )
    return scored.withColumn("data_quality_score", _bounded(points))


def score_signs(profile: DataFrame, policy: Policy = Policy()) -> DataFrame:
    """Model C: nulls up to 50 points, 10 for negative amounts, 5 for blanks, 10 more for identifiers."""
    negative = F.col("column_name").rlike(policy.amount_pattern) & (F.col("negative_count") > 0)
    points = (
        F.lit(100.0)
        - _null_points(F.col("null_pct"))
        + _id_bonus(policy)
        - F.when(negative, NEGATIVE_POINTS).otherwise(0)
        - F.when(F.col("blank_count") > 0, BLANK_POINTS).otherwise(0)
    )
    return profile.withColumn("data_quality_score", _bounded(points))


def score_nulls(profile: DataFrame) -> DataFrame:
    """Model D: 100 less the null percentage."""
    return profile.withColumn("data_quality_score", half_up(F.lit(100.0) - F.col("null_pct"), 1))


# The names of the bands in the one report and in the other.
STATUS_BANDS = ("good", "warning", "error")
GRADE_BANDS = ("excellent", "good", "poor")


def score_band(score: Column, names: tuple[str, str, str] = STATUS_BANDS) -> Column:
    best, middle, worst = names
    return F.when(score >= GOOD_FROM, best).when(score >= FAIR_FROM, middle).otherwise(worst)
