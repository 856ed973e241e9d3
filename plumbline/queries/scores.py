"""Quality scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.functions.frames import union_all
from plumbline.operators import outliers, profile, scoring
from plumbline.plans.daily import assess
from plumbline.queries import sql
from plumbline.queries.inputs import ASSESSED, POLICY, SCHEMAS, sources
from plumbline.queries.registry import query
from plumbline.queries.rules import FINDINGS_SQL
from plumbline.queries.sql import relation, r

_SCORE = ["table_name", "column_name", "data_quality_score"]

SCORE_A_SQL = (
    FINDINGS_SQL
    + """,
scored AS (
  SELECT p.*,
    (SELECT count(*) FROM alerts a WHERE a.table_name = p.table_name AND a.column_name = p.column_name
       AND a.severity = 'CRITICAL') AS critical,
    (SELECT count(*) FROM alerts a WHERE a.table_name = p.table_name AND a.column_name = p.column_name
       AND a.severity = 'WARNING') AS warning,
    (SELECT count(*) FROM checks c WHERE c.table_name = p.table_name AND c.column_name = p.column_name
       AND c.status = 'FAIL') AS failed
  FROM p),
score_a AS (
  SELECT *, CASE WHEN total_rows = 0 THEN 0.0 ELSE greatest("""
    + r("100 - 30 * critical - 10 * warning - 20 * failed - least(null_pct / 2, 25)", 1)
    + """, 0.0) END AS data_quality_score FROM scored)
"""
)


@query(
    "score_model_a",
    SCORE_A_SQL
    + "SELECT table_name, column_name, critical AS critical_alerts, warning AS warning_alerts, "
    "failed AS failed_checks, data_quality_score FROM score_a",
)
def score_model_a(spark, sf_dir):
    assessed = assess(sources(spark, sf_dir, ASSESSED), POLICY, stats=profile.WITHOUT_SPREAD)
    counts = [F.col(c).cast("bigint").alias(c) for c in ("critical_alerts", "warning_alerts", "failed_checks")]
    return assessed.select("table_name", "column_name", *counts, "data_quality_score")


_AMOUNT = "regexp_matches(column_name, '(acctbal|price|quantity|size)$')"
_ID = "regexp_matches(column_name, '(key|_id)$') AND round(CAST(coalesce(uniqueness_pct, 0) AS DECIMAL(38,9)), 2) > 95"


def _clamped(points: str) -> str:
    return f"greatest(0.0, least(100.0, {r(points, 1)}))"


_DEVIATIONS = POLICY.outlier_deviations


def _outliers_sql(tables: list[str]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{t}' AS table_name, '{c}' AS column_name,
              count(*) FILTER (abs({c} - s.m) > {_DEVIATIONS} * s.sd) AS outlier_count
            FROM {relation(t)},
              (SELECT avg({c}) AS m, stddev_samp({c}) AS sd FROM {relation(t)}) s"""
        for t in tables
        for c, _, kind in SCHEMAS[t]
        if kind == "n"
    )


_ISSUES = (
    "(CASE WHEN coalesce(o.outlier_count, 0) > 0 THEN 1 ELSE 0 END "
    f"+ CASE WHEN {_AMOUNT.replace('column_name', 'p.column_name')} AND coalesce(negative_count, 0) > 0 "
    "THEN 1 ELSE 0 END + CASE WHEN coalesce(blank_count, 0) > 0 THEN 1 ELSE 0 END)"
)


@query(
    "score_model_b",
    f"""WITH p AS ({sql.profile(ASSESSED)}), o AS ({_outliers_sql(ASSESSED)}),
        counted AS (
          SELECT p.*, {_ISSUES} AS issue_count FROM p LEFT JOIN o
            ON p.table_name = o.table_name AND p.column_name = o.column_name)
        SELECT table_name, column_name, CAST(issue_count AS INTEGER) AS issue_count,
          {_clamped(f"100 - least(null_pct, 50) - 10 * issue_count + CASE WHEN {_ID} THEN 10 ELSE 0 END")}
            AS data_quality_score
        FROM counted""",
)
def score_model_b(spark, sf_dir):
    tables = sources(spark, sf_dir, ASSESSED)
    far = union_all([outliers.outlier_counts(df, name, _DEVIATIONS) for name, df in tables.items()])
    scored = scoring.score_issues(profile.profile_tables(tables, stats=profile.WITHOUT_SPREAD), far, POLICY)
    return scored.select("table_name", "column_name", "issue_count", "data_quality_score")


SCORE_C = _clamped(
    f"100 - least(null_pct, 50) + CASE WHEN {_ID} THEN 10 ELSE 0 END "
    f"- CASE WHEN {_AMOUNT} AND coalesce(negative_count, 0) > 0 THEN 10 ELSE 0 END "
    "- CASE WHEN coalesce(blank_count, 0) > 0 THEN 5 ELSE 0 END"
)


@query(
    "score_model_c",
    f"""SELECT table_name, column_name, {SCORE_C} AS data_quality_score FROM ({sql.profile(ASSESSED)})""",
)
def score_model_c(spark, sf_dir):
    profiled = profile.profile_tables(sources(spark, sf_dir, ASSESSED), stats=profile.WITHOUT_SPREAD)
    return scoring.score_signs(profiled, POLICY).select(*_SCORE)


@query(
    "score_model_d",
    f"""SELECT table_name, column_name, {r("100 - null_pct", 1)} AS data_quality_score
        FROM ({sql.profile(ASSESSED, distinct=False)})""",
)
def score_model_d(spark, sf_dir):
    profiled = profile.profile_tables(sources(spark, sf_dir, ASSESSED), distinct="none", stats=())
    return scoring.score_nulls(profiled).select(*_SCORE)


@query(
    "score_bands",
    SCORE_A_SQL
    + """SELECT table_name, CASE WHEN data_quality_score >= 80 THEN 'good'
           WHEN data_quality_score >= 60 THEN 'warning' ELSE 'error' END AS band,
           CASE WHEN data_quality_score >= 80 THEN 'excellent' WHEN data_quality_score >= 60 THEN 'good'
             ELSE 'poor' END AS grade, count(*) AS columns
         FROM score_a GROUP BY ALL""",
)
def score_bands(spark, sf_dir):
    assessed = assess(sources(spark, sf_dir, ASSESSED), POLICY, stats=profile.WITHOUT_SPREAD)
    score = F.col("data_quality_score")
    band = scoring.score_band(score).alias("band")
    grade = scoring.score_band(score, scoring.GRADE_BANDS).alias("grade")
    return assessed.groupBy("table_name", band, grade).agg(F.count(F.lit(1)).alias("columns"))
