"""Reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.functions.frames import union_all
from plumbline.operators import checks, profile, report, table_checks
from plumbline.operators.snapshot import run_seed
from plumbline.plans.daily import assess, detail_with_values
from plumbline.plans.policy import Range
from plumbline.queries import sql
from plumbline.queries.inputs import ASSESSED, POLICY, SCHEMAS, sources
from plumbline.queries.profiles import top_sql
from plumbline.queries.registry import query, rounded, table
from plumbline.queries.rules import FINDINGS_SQL
from plumbline.queries.scores import SCORE_A_SQL, SCORE_C
from plumbline.queries.sql import pct, r
from plumbline.sources import read_documents, work_dir, write_documents, write_lines

_DETAILED = ["patchy_orders", "customer", "part", "labelled_documents"]
_SHOWN = "left(coalesce(value, 'None'), 20)"


def _issues_sql() -> str:
    amount = "regexp_matches(p.column_name, '(acctbal|price|quantity|size)$')"
    return (
        f"concat_ws('; ', CASE WHEN {amount} AND negative_count > 0 THEN negative_count || "
        "' negative values' END, CASE WHEN blank_count > 0 THEN blank_count || ' empty strings' END)"
    )


@query(
    "report_detail",
    f"""WITH p AS ({sql.profile(_DETAILED)}), best AS ({top_sql(_DETAILED, 3)}),
        shown AS (SELECT table_name, column_name,
            string_agg({_SHOWN}, ', ' ORDER BY position) AS top_values,
            max(value) FILTER (position = 1) AS most_frequent_value
          FROM best GROUP BY 1, 2),
        scored AS (SELECT *, {SCORE_C} AS data_quality_score FROM p)
        SELECT p.table_name, p.column_name, p.data_type, p.total_rows, p.null_count,
          {r("p.null_pct", 2)} AS null_percentage, p.distinct_count,
          {r("p.uniqueness_pct", 2)} AS unique_percentage, {r("p.min_num", 4)} AS min_value,
          {r("p.max_num", 4)} AS max_value, {r("p.mean", 2)} AS mean_value, s.most_frequent_value,
          CASE WHEN p.kind = 'n' AND p.min_num IS NOT NULL
            THEN printf('%.2f', {r("p.min_num", 2)}) || ' - ' || printf('%.2f', {r("p.max_num", 2)})
            ELSE coalesce(s.top_values, '') END AS range_or_values,
          p.data_quality_score, {_issues_sql()} AS issues
        FROM scored p LEFT JOIN shown s
          ON p.table_name = s.table_name AND p.column_name = s.column_name""",
)
def report_detail(spark, sf_dir):
    return rounded(
        detail_with_values(sources(spark, sf_dir, _DETAILED), POLICY), 4, "min_value", "max_value"
    )


@query(
    "report_by_check",
    f"""SELECT 'volume' AS check_type, t AS table_name, CAST(NULL AS VARCHAR) AS column_name,
          CAST(n AS DOUBLE) AS actual, CASE WHEN n BETWEEN 100 AND 50000 THEN 'PASS' ELSE 'FAIL' END
            AS status
        FROM (SELECT 'orders' AS t, count(*) AS n FROM orders
              UNION ALL SELECT 'lineitem', count(*) FROM lineitem)
        UNION ALL
        SELECT 'null_validation', table_name, column_name, {r("null_pct", 2)},
          CASE WHEN null_pct <= 50 THEN 'PASS' ELSE 'FAIL' END
        FROM ({sql.profile(["patchy_orders"], distinct=False)})
        UNION ALL
        SELECT 'range_checks', 'lineitem', 'l_quantity',
          {r(pct("count(*) FILTER (l_quantity < 2 OR l_quantity > 50)", "count(*)"), 2)},
          CASE WHEN {pct("count(*) FILTER (l_quantity < 2 OR l_quantity > 50)", "count(*)")} <= 5
            THEN 'PASS' ELSE 'FAIL' END FROM lineitem
        UNION ALL
        SELECT 'freshness', 'orders', 'o_orderdate',
          {r("(epoch_us(TIMESTAMP '2024-02-02 00:00:00') - epoch_us(max(o_orderdate))) / 3.6e9", 2)},
          CASE WHEN (epoch_us(TIMESTAMP '2024-02-02 00:00:00') - epoch_us(max(o_orderdate))) / 3.6e9 <= 24
            THEN 'PASS' ELSE 'FAIL' END FROM orders
        UNION ALL SELECT 'freshness', 'customer', NULL, NULL, 'SKIP' FROM (SELECT count(*) FROM customer)""",
)
def report_by_check(spark, sf_dir):
    names = ["orders", "lineitem"]
    counts = union_all([table_checks.row_counts(table(spark, sf_dir, t), t) for t in names])
    limits = {t: Range(100, 50_000) for t in names}
    volume = checks.volume_checks(counts, limits).select(
        "check_type",
        "table_name",
        F.lit(None).cast("string").alias("column_name"),
        F.col("record_count").cast("double").alias("actual"),
        "status",
    )
    patchy = sources(spark, sf_dir, ["patchy_orders"])
    nulls = checks.column_findings(
        profile.profile_tables(patchy, distinct="none", stats=()), POLICY, ["null_validation"]
    ).select("check_type", "table_name", "column_name", "actual", "status")
    ranged = table_checks.range_checks(
        table(spark, sf_dir, "lineitem"), "lineitem", {"l_quantity": Range(2, 50)}
    ).select(
        "check_type", "table_name", "column_name", F.col("violation_pct").alias("actual"), "status"
    )
    fresh = union_all(
        [
            table_checks.freshness_check(table(spark, sf_dir, t), t, "2024-02-02 00:00:00").select(
                "check_type", "table_name", "column_name", F.col("hours_old").alias("actual"), "status"
            )
            for t in ("orders", "customer")
        ]
    )
    return rounded(union_all([volume, nulls, ranged, fresh]), 2, "actual")


_TOTALS = [(t, len(SCHEMAS[t])) for t in ASSESSED]


@query(
    "run_totals",
    "SELECT count(*) AS total_tables, count(n) AS successful_tables, CAST(sum(n) AS BIGINT) AS total_rows, "
    f"CAST(sum(c) AS BIGINT) AS total_columns, {r('avg(c)', 2)} AS avg_columns_per_table FROM ("
    + " UNION ALL ".join(
        f"SELECT count(*) AS n, {width} AS c FROM {sql.relation(t)}" for t, width in _TOTALS
    )
    + " UNION ALL SELECT NULL, 0)",
)
def run_totals(spark, sf_dir):
    """Totals over the tables, one of which could not be analysed."""
    profiled = profile.profile_tables(sources(spark, sf_dir, ASSESSED), distinct="none", stats=())
    tables = report.table_results(profiled)
    failed = checks.literal_rows(spark, [("returns",)], "table_name string")
    everything = tables.unionByName(failed, allowMissingColumns=True)
    return rounded(report.run_totals(everything), 2, "avg_columns_per_table")


_LINES = ["orders", "lineitem", "customer", "events"]
_LINE_COUNTS = " UNION ALL ".join(f"SELECT '{t}' AS t, count(*) AS n, {len(SCHEMAS[t])} AS w FROM {t}" for t in _LINES)


@query(
    "summary_lines",
    f"""WITH c AS ({_LINE_COUNTS})
        SELECT 'DAILY DATA QUALITY ANALYSIS' AS line FROM c HAVING count(*) > 0
        UNION ALL SELECT repeat('=', 50)
        UNION ALL SELECT 'Generated: 2024-01-31 00:00:00'
        UNION ALL SELECT 'Simulation ID: 20240131_000000'
        UNION ALL SELECT 'Random Seed: {run_seed("2024-01-31")}'
        UNION ALL SELECT 'Simulation Date: 2024-01-31'
        UNION ALL SELECT 'Total Tables: ' || count(*) FROM c
        UNION ALL SELECT 'Successful: ' || count(*) FROM c
        UNION ALL SELECT 'Failed: 0'
        UNION ALL SELECT format('Total Rows: {{:,}}', CAST(sum(n) AS BIGINT)) FROM c
        UNION ALL SELECT 'Total Business Columns: ' || sum(w) FROM c
        UNION ALL SELECT t || format(': {{:,}} rows, ', n) || w || ' columns (seed: {run_seed("2024-01-31")})' FROM c""",
)
def summary_lines(spark, sf_dir):
    counts = union_all([table_checks.row_counts(table(spark, sf_dir, t), t) for t in _LINES])
    widths = F.create_map(*[F.lit(x) for t in _LINES for x in (t, len(SCHEMAS[t]))])
    tables = counts.select(
        "table_name",
        F.col("record_count").alias("total_rows"),
        widths[F.col("table_name")].alias("business_columns"),
    )
    path = work_dir(spark, "summary")
    lines = report.summary_lines(
        tables, "DAILY DATA QUALITY ANALYSIS", "20240131_000000", "2024-01-31 00:00:00", "2024-01-31", run_seed("2024-01-31")
    )
    write_lines(lines, path)
    return spark.read.text(path).withColumnRenamed("value", "line")


def _document(spark, sf_dir):
    assessed = assess(sources(spark, sf_dir, ASSESSED), POLICY, stats=profile.WITHOUT_SPREAD)
    return report.run_document(assessed, "20240131_000000", "2024-01-31T00:00:00")


@query("run_document")
def run_document(spark, sf_dir):
    return _document(spark, sf_dir)


@query(
    "parse_run_document",
    SCORE_A_SQL
    + f"""SELECT '20240131_000000' AS run_id, table_name, column_name, data_type, total_rows, null_count,
            {r("null_pct", 2)} AS null_percentage, distinct_count, {r("mean", 2)} AS average_value,
            max_len AS max_length, data_quality_score
          FROM score_a""",
)
def parse_run_document(spark, sf_dir):
    """A run document written, and read back by the time stamp in its path."""
    path = f"{work_dir(spark, 'documents')}/run_id=20240131_000000"
    write_documents(_document(spark, sf_dir), path)
    columns = report.document_columns(read_documents(spark, f"{path}/*.json", report.DOCUMENT_SCHEMA))
    return columns.select(
        "run_id",
        "table_name",
        "column_name",
        "data_type",
        "total_rows",
        "null_count",
        "null_percentage",
        "distinct_count",
        "average_value",
        "max_length",
        "data_quality_score",
    )


@query(
    "run_metrics",
    FINDINGS_SQL
    + """SELECT (SELECT CAST(sum(n) AS BIGINT) FROM
             (SELECT table_name, max(total_rows) AS n FROM p GROUP BY 1)) AS rows_processed,
           (SELECT count(*) FROM p) AS columns_analyzed,
           (SELECT count(*) FROM checks) AS quality_checks_performed,
           (SELECT count(*) FROM alerts) AS alerts_generated""",
)
def run_metrics(spark, sf_dir):
    """The counts of a run; its duration is no part of a comparable result."""
    assessed = assess(sources(spark, sf_dir, ASSESSED), POLICY, stats=profile.WITHOUT_SPREAD)
    return report.run_metrics(assessed).drop("execution_time_seconds")
