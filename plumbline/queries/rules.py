"""Checks over profiles and tables, and their roll-ups."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.functions.frames import union_all
from plumbline.operators import checks, profile, rollup, table_checks
from plumbline.plans.policy import Range, TableRules
from plumbline.plans.rules import evaluate_rules
from plumbline.queries import sql
from plumbline.queries.inputs import ASSESSED, POLICY, event_runs, sources
from plumbline.queries.registry import query, rounded, table
from plumbline.queries.sql import pct, r

_NULLS = f"({sql.profile(ASSESSED, distinct=False)})"


def _findings(spark, sf_dir, only, distinct="none", stats=(), named=""):
    tables = sources(spark, sf_dir, ASSESSED)
    found = profile.profile_tables(tables, distinct=distinct, stats=stats, named=named)
    return rounded(checks.column_findings(found, POLICY, only), 2, "actual")


@query(
    "check_empty",
    f"""SELECT table_name, column_name, 'CRITICAL' AS severity, 'No data found' AS message
        FROM {_NULLS} WHERE total_rows = 0""",
)
def check_empty(spark, sf_dir):
    found = _findings(spark, sf_dir, ["empty_table"])
    return found.select("table_name", "column_name", "severity", "message")


_BAND = (
    "CASE WHEN null_pct > 95 THEN 'CRITICAL' WHEN null_pct > 50 THEN 'WARNING' "
    "WHEN null_pct > 20 THEN 'INFO' END"
)
_BAND_TEXT = (
    f"printf('%.2f', {r('null_pct', 2)}) || '% null values - ' || CASE WHEN null_pct > 95 THEN "
    "'data integrity issue' WHEN null_pct > 50 THEN 'high null rate' ELSE 'moderate null rate' END"
)


@query(
    "check_null_bands",
    f"""SELECT table_name, column_name, {_BAND} AS severity, {r("null_pct", 2)} AS actual,
          {_BAND_TEXT} AS message
        FROM {_NULLS} WHERE total_rows > 0 AND null_pct > 20""",
)
def check_null_bands(spark, sf_dir):
    found = _findings(spark, sf_dir, ["null_band"])
    return found.select("table_name", "column_name", "severity", "actual", "message")


@query(
    "check_null_validation",
    f"""SELECT table_name, column_name, CASE WHEN null_pct <= 50 THEN 'PASS' ELSE 'FAIL' END AS status,
          '<=50%' AS threshold, {r("null_pct", 2)} AS actual
        FROM {_NULLS} WHERE total_rows > 0""",
)
def check_null_validation(spark, sf_dir):
    found = _findings(spark, sf_dir, ["null_validation"])
    return found.select("table_name", "column_name", "status", "threshold", "actual")


_CRITICAL = {
    "patchy_orders": ("o_orderkey", "o_open_status", "o_absent"),
    "lineitem": ("l_orderkey", "l_partkey"),
    "labelled_documents": ("doc_id", "text"),
    "customer": ("c_custkey",),
}
_WATCHED = {
    "patchy_orders": ("o_totalprice", "o_large_price"),
    "labelled_documents": ("quality", "toxic", "n_chars"),
}
# The second rule set: critical columns only, other lists.
_CRITICAL_ONLY = {
    "patchy_orders": ("o_orderkey", "o_large_price"),
    "labelled_documents": ("doc_id", "quality"),
    "customer": ("c_custkey", "c_acctbal"),
}


def _limit_sql(critical: dict, watched: dict) -> str:
    rows = [f"('{t}', '{c}', 5.0, true)" for t, names in critical.items() for c in names]
    rows += [f"('{t}', '{c}', 20.0, false)" for t, names in watched.items() for c in names]
    return f"""SELECT p.table_name, p.column_name, p.null_count, p.total_rows,
          {r("p.null_pct", 2)} AS null_pct, CAST(v.limit_pct AS DOUBLE) AS limit_pct, v.is_critical,
          CASE WHEN p.null_pct <= v.limit_pct THEN 'PASS' ELSE 'FAIL' END AS status
        FROM {_NULLS} p
        JOIN (VALUES {", ".join(rows)}) v(table_name, column_name, limit_pct, is_critical)
          ON p.table_name = v.table_name AND p.column_name = v.column_name"""


def _limit_checks(spark, sf_dir, critical, watched=None):
    names = list({**critical, **(watched or {})})
    found = profile.profile_tables(sources(spark, sf_dir, names), distinct="none", stats=())
    limits = checks.null_limits(spark, critical, watched)
    return rounded(checks.null_limit_checks(found, limits), 2, "null_pct").drop("check_type")


@query("check_null_critical", _limit_sql(_CRITICAL, _WATCHED))
def check_null_critical(spark, sf_dir):
    return _limit_checks(spark, sf_dir, _CRITICAL, _WATCHED)


@query("check_null_critical_only", _limit_sql(_CRITICAL_ONLY, {}))
def check_null_critical_only(spark, sf_dir):
    return _limit_checks(spark, sf_dir, _CRITICAL_ONLY)


_EXACT = f"({sql.profile(ASSESSED)})"
_IS_ID = "regexp_matches(column_name, '(key|_id)$') AND uniqueness_pct IS NOT NULL"


@query(
    "check_id_uniqueness",
    f"""SELECT table_name, column_name, 'check' AS record, CAST(NULL AS VARCHAR) AS severity,
          CASE WHEN uniqueness_pct >= 95 THEN 'PASS' ELSE 'FAIL' END AS status, '>=95%' AS threshold,
          {r("uniqueness_pct", 2)} AS actual
        FROM {_EXACT} WHERE {_IS_ID}
        UNION ALL
        SELECT table_name, column_name, 'alert', 'WARNING', NULL, NULL, {r("uniqueness_pct", 2)}
        FROM {_EXACT} WHERE {_IS_ID} AND uniqueness_pct < 95""",
)
def check_id_uniqueness(spark, sf_dir):
    found = _findings(spark, sf_dir, ["id_uniqueness"], distinct="exact", named=POLICY.id_pattern)
    return found.select(
        "table_name", "column_name", "record", "severity", "status", "threshold", "actual"
    )


_NUMERIC = "kind = 'n' AND non_null_count > 0"


@query(
    "check_domain_01",
    f"""SELECT table_name, column_name, 'ERROR' AS severity,
          'values outside [0,1]: ' || printf('%.2f', {r("min_num", 2)}) || ' to ' || printf('%.2f', {r("max_num", 2)})
            AS message
        FROM {_NULLS} WHERE {_NUMERIC} AND regexp_matches(column_name, '^(quality|toxic|label)$')
          AND (min_num < 0 OR max_num > 1)""",
)
def check_domain_01(spark, sf_dir):
    found = _findings(spark, sf_dir, ["binary_domain"], stats=["range"], named=POLICY.binary_pattern)
    return found.select("table_name", "column_name", "severity", "message")


@query(
    "check_sign_rules",
    f"""SELECT table_name, column_name, 'non_positive' AS check_type, 'WARNING' AS severity,
          {r("max_num", 2)} AS actual
        FROM {_NULLS} WHERE {_NUMERIC} AND regexp_matches(column_name, '(discount|tax)$') AND max_num > 0
        UNION ALL
        SELECT table_name, column_name, 'non_negative', 'WARNING', {r("min_num", 2)}
        FROM {_NULLS} WHERE {_NUMERIC} AND min_num < 0
          AND regexp_matches(column_name, '(acctbal|price|value)$')""",
)
def check_sign_rules(spark, sf_dir):
    found = _findings(spark, sf_dir, ["non_positive", "non_negative"], stats=["range"])
    return found.select("table_name", "column_name", "check_type", "severity", "actual")


@query(
    "check_constant",
    f"""SELECT table_name, column_name, 'INFO' AS severity,
          'constant value: ' || printf('%.2f', {r("min_num", 2)}) AS message
        FROM {_NULLS} WHERE {_NUMERIC} AND range_span = 0""",
)
def check_constant(spark, sf_dir):
    found = _findings(spark, sf_dir, ["constant"], stats=["range"])
    return found.select("table_name", "column_name", "severity", "message")


@query(
    "check_strings",
    f"""WITH p AS (SELECT * FROM {_NULLS} WHERE kind = 's' AND non_null_count > 0)
        SELECT table_name, column_name, 'empty_string' AS check_type, 'WARNING' AS severity,
          CAST(NULL AS VARCHAR) AS status, 'contains empty strings' AS message FROM p WHERE min_len = 0
        UNION ALL
        SELECT table_name, column_name, 'long_string', 'INFO', NULL,
          'very long strings (max: ' || max_len || ')' FROM p WHERE max_len > 1000
        UNION ALL
        SELECT table_name, column_name, 'string_length_validation', NULL, 'PASS',
          min_len || ' to ' || max_len || ' characters' FROM p""",
)
def check_strings(spark, sf_dir):
    wanted = ["empty_string", "long_string", "string_length_validation"]
    found = _findings(spark, sf_dir, wanted, stats=["lengths"])
    return found.select("table_name", "column_name", "check_type", "severity", "status", "message")


_FINDINGS_SQL = f"""
WITH p AS (SELECT * FROM {_EXACT}),
alerts AS (
  SELECT table_name, column_name, 'empty_table' AS check_type, 'CRITICAL' AS severity
    FROM p WHERE total_rows = 0
  UNION ALL SELECT table_name, column_name, 'null_band', {_BAND} FROM p WHERE null_pct > 20
  UNION ALL SELECT table_name, column_name, 'id_uniqueness', 'WARNING' FROM p
    WHERE {_IS_ID} AND uniqueness_pct < 95
  UNION ALL SELECT table_name, column_name, 'binary_domain', 'ERROR' FROM p
    WHERE {_NUMERIC} AND regexp_matches(column_name, '^(quality|toxic|label)$')
      AND (min_num < 0 OR max_num > 1)
  UNION ALL SELECT table_name, column_name, 'non_positive', 'WARNING' FROM p
    WHERE {_NUMERIC} AND regexp_matches(column_name, '(discount|tax)$') AND max_num > 0
  UNION ALL SELECT table_name, column_name, 'non_negative', 'WARNING' FROM p
    WHERE {_NUMERIC} AND regexp_matches(column_name, '(acctbal|price|value)$') AND min_num < 0
  UNION ALL SELECT table_name, column_name, 'constant', 'INFO' FROM p
    WHERE {_NUMERIC} AND range_span = 0
  UNION ALL SELECT table_name, column_name, 'empty_string', 'WARNING' FROM p
    WHERE kind = 's' AND min_len = 0
  UNION ALL SELECT table_name, column_name, 'long_string', 'INFO' FROM p
    WHERE kind = 's' AND max_len > 1000),
checks AS (
  SELECT table_name, column_name, 'null_validation' AS check_type,
      CASE WHEN null_pct <= 50 THEN 'PASS' ELSE 'FAIL' END AS status FROM p WHERE total_rows > 0
  UNION ALL SELECT table_name, column_name, 'id_uniqueness',
      CASE WHEN uniqueness_pct >= 95 THEN 'PASS' ELSE 'FAIL' END FROM p WHERE {_IS_ID}
  UNION ALL SELECT table_name, column_name, 'numeric_range_validation', 'PASS' FROM p WHERE {_NUMERIC}
  UNION ALL SELECT table_name, column_name, 'string_length_validation', 'PASS' FROM p
    WHERE kind = 's' AND non_null_count > 0)
"""
FINDINGS_SQL = _FINDINGS_SQL


def over_profile(findings: str, profiled: str) -> str:
    """The same findings, or scores, over another profile."""
    return findings.replace(_EXACT, f"({profiled})")


@query(
    "alert_severity",
    _FINDINGS_SQL
    + """SELECT table_name, severity, CASE severity WHEN 'CRITICAL' THEN 'critical'
           WHEN 'WARNING' THEN 'warning' ELSE 'info' END AS alert_class, count(*) AS alerts
         FROM alerts GROUP BY ALL""",
)
def alert_severity(spark, sf_dir):
    found = _findings(spark, sf_dir, None, distinct="exact").where("record = 'alert'")
    return found.groupBy(
        "table_name", "severity", checks.alert_class(F.col("severity")).alias("alert_class")
    ).agg(F.count(F.lit(1)).alias("alerts"))


@query(
    "column_findings",
    _FINDINGS_SQL
    + """SELECT table_name, column_name, check_type, severity, CAST(NULL AS VARCHAR) AS status FROM alerts
         UNION ALL SELECT table_name, column_name, check_type, NULL, status FROM checks""",
)
def all_findings(spark, sf_dir):
    found = _findings(spark, sf_dir, None, distinct="exact")
    return found.select("table_name", "column_name", "check_type", "severity", "status")


_VOLUMES = {
    "orders": Range(1_000, 50_000),
    "lineitem": Range(1_000, 50_000),
    "customer": Range(2_000, 100_000),
    "events": Range(10_000, 500_000),
}
_COUNTED = ["orders", "lineitem", "customer", "events", "supplier", "nation", "documents"]


def _volume_sql() -> str:
    counts = " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS n, "
        f"CAST({int(_VOLUMES[t].low) if t in _VOLUMES else 100} AS BIGINT) AS lo, "
        f"CAST({int(_VOLUMES[t].high) if t in _VOLUMES else 1000000} AS BIGINT) AS hi FROM {t}"
        for t in _COUNTED
    )
    return f"""SELECT table_name, 'volume' AS check_type, n AS record_count, lo AS min_threshold,
          hi AS max_threshold, CASE WHEN n BETWEEN lo AND hi THEN 'PASS' ELSE 'FAIL' END AS status,
          CASE WHEN n < lo THEN format('Record count {{:,}} below minimum {{:,}}', n, lo)
               WHEN n > hi THEN format('Record count {{:,}} above maximum {{:,}}', n, hi)
               ELSE format('Record count {{:,}} within acceptable range', n) END AS message
        FROM ({counts})"""


@query("check_volume", _volume_sql())
def check_volume(spark, sf_dir):
    counts = union_all([table_checks.row_counts(table(spark, sf_dir, t), t) for t in _COUNTED])
    return checks.volume_checks(counts, _VOLUMES)


_RANGES = {
    "orders": {
        "o_totalprice": Range(2000, 450000),
        "o_custkey": Range(0, 10_000_000),
        "o_absent": Range(0, 1),
    },
    "lineitem": {"l_quantity": Range(2, 50), "l_discount": Range(0, 0.09)},
    "events": {"value": Range(0, 200)},
    "part": {},
}


def _range_sql(tolerance: float) -> str:
    rows = [
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, CAST({b.low} AS DOUBLE) AS min_allowed, "
        f"CAST({b.high} AS DOUBLE) AS max_allowed, count(*) AS total_rows, "
        f"count(*) FILTER ({c} < {b.low} OR {c} > {b.high}) AS violations, "
        f"CAST(NULL AS VARCHAR) AS message FROM {t}"
        for t, ranges in _RANGES.items()
        for c, b in ranges.items()
        if c != "o_absent"
    ]
    rows.append(
        "SELECT 'part', NULL, NULL, NULL, count(*), 0, 'No range rules defined for this table' FROM part"
    )
    share = pct("violations", "total_rows")
    return f"""SELECT *, {r(share, 2)} AS violation_pct,
          CASE WHEN {share} <= {tolerance} THEN 'PASS' ELSE 'FAIL' END AS status
        FROM ({" UNION ALL ".join(rows)})"""


def _range_checks(spark, sf_dir, tolerance):
    found = union_all(
        [
            table_checks.range_checks(table(spark, sf_dir, t), t, ranges, tolerance)
            for t, ranges in _RANGES.items()
        ]
    )
    return rounded(found, 2, "violation_pct").drop("check_type")


@query("check_range_tolerant", _range_sql(5.0))
def check_range_tolerant(spark, sf_dir):
    return _range_checks(spark, sf_dir, 5.0)


@query("check_range_strict", _range_sql(0.0))
def check_range_strict(spark, sf_dir):
    return _range_checks(spark, sf_dir, 0.0)


def _freshness_sql(table_name: str, column: str, as_of: str, expr: str | None = None) -> str:
    hours = f"(epoch_us(TIMESTAMP '{as_of}') - epoch_us(max({expr or column}))) / 3.6e9"
    return f"""SELECT '{table_name}' AS table_name, '{column}' AS column_name,
          CAST(24 AS DOUBLE) AS threshold_hours, count(*) AS total_rows, {r(hours, 2)} AS hours_old,
          CASE WHEN max({expr or column}) IS NULL THEN 'SKIP' WHEN {hours} <= 24 THEN 'PASS'
            ELSE 'FAIL' END AS status,
          CASE WHEN max({expr or column}) IS NULL THEN 'No valid timestamps found'
            ELSE printf('Data is %.1f hours old', {r(hours, 1)}) END AS message
        FROM {table_name}"""


def _without_column(table_name: str, status: str) -> str:
    return f"""SELECT '{table_name}', NULL, CAST(24 AS DOUBLE), count(*), NULL, '{status}',
          'No timestamp column found' FROM {table_name}"""


@query(
    "freshness",
    " UNION ALL ".join(
        [
            _freshness_sql("events", "ts", "2024-01-31 00:00:00"),
            _freshness_sql("orders", "o_orderdate", "2024-02-02 00:00:00"),
            _without_column("customer", "SKIP"),
            _without_column("supplier", "PASS"),
        ]
    ),
)
def freshness(spark, sf_dir):
    found = union_all(
        [
            table_checks.freshness_check(
                table(spark, sf_dir, "events"), "events", "2024-01-31 00:00:00"
            ),
            table_checks.freshness_check(
                table(spark, sf_dir, "orders"), "orders", "2024-02-02 00:00:00"
            ),
            table_checks.freshness_check(
                table(spark, sf_dir, "customer"), "customer", "2024-02-02 00:00:00"
            ),
            table_checks.freshness_check(
                table(spark, sf_dir, "supplier"), "supplier", "2024-02-02 00:00:00", no_column="PASS"
            ),
        ]
    )
    return rounded(found, 2, "hours_old").drop("check_type")


@query(
    "freshness_iso",
    _freshness_sql("events", "stamp", "2024-02-02 00:00:00", "CASE WHEN event_type <> 'error' THEN date_trunc('second', ts) END"),
)
def freshness_iso(spark, sf_dir):
    """The time stamp arrives as ISO text in UTC; text that is no time stamp counts as missing."""
    events = table(spark, sf_dir, "events")
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    stamp = F.when(F.col("event_type") == "error", "n/a").otherwise(iso)
    found = table_checks.freshness_check(
        events.select(stamp.alias("stamp")), "events", "2024-02-02T00:00:00Z", column="stamp"
    )
    return rounded(found, 2, "hours_old").drop("check_type")


# --- results per run ----------------------------------------------------------------------

_DAY_RULES = TableRules(
    volume=Range(320, 345),
    ranges={"value": Range(0, 100)},
    range_tolerance_pct=12.5,
    patterns={"event_type": "^(?:click|view|signup|purchase)$"},
    pattern_tolerance_pct=20.0,
)


def run_results(spark, sf_dir):
    """Volume, range and event type checks of each day of events."""
    runs = event_runs(spark, sf_dir)
    found = evaluate_rules({"events": runs}, {"events": _DAY_RULES}, by="run_id")
    return found.select("run_id", "table_name", "check_type", "status")


def _status(condition: str) -> str:
    return f"CASE WHEN {condition} THEN 'PASS' ELSE 'FAIL' END"


RUN_RESULTS_SQL = f"""
days AS (
  SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS run_id, count(*) AS n,
    count(*) FILTER (value < 0 OR value > 100) AS far, count(*) FILTER (event_type = 'error') AS errors
  FROM events GROUP BY 1),
results AS (
  SELECT run_id, 'events' AS table_name, 'volume' AS check_type,
    {_status("n BETWEEN 320 AND 345")} AS status FROM days
  UNION ALL SELECT run_id, 'events', 'range_checks', {_status(pct("far", "n") + " <= 12.5")} FROM days
  UNION ALL SELECT run_id, 'events', 'pattern', {_status(pct("errors", "n") + " <= 20")} FROM days)
"""


@query("run_results", f"WITH {RUN_RESULTS_SQL} SELECT * FROM results")
def results_per_run(spark, sf_dir):
    return run_results(spark, sf_dir)


# --- roll-ups -----------------------------------------------------------------------------


def _table_results(spark, sf_dir):
    """Volume, null, range and freshness results of several tables."""
    keys = ["table_name", "check_type", "status"]
    names = ["orders", "lineitem", "customer", "events", "part"]
    tables = sources(spark, sf_dir, names)
    counts = union_all([table_checks.row_counts(df, name) for name, df in tables.items()])
    ranged = [
        table_checks.range_checks(tables[t], t, ranges, 5.0).select(*keys)
        for t, ranges in _RANGES.items()
    ]
    fresh = [
        table_checks.freshness_check(df, name, "2024-02-02 00:00:00").select(*keys)
        for name, df in tables.items()
    ]
    return union_all([checks.volume_checks(counts, _VOLUMES).select(*keys), *ranged, *fresh])


def _latest(name: str, column: str) -> str:
    hours = f"(epoch_us(TIMESTAMP '2024-02-02 00:00:00') - epoch_us(max({column}))) / 3.6e9"
    return f"SELECT '{name}', 'freshness', {_status(hours + ' <= 24')} FROM {name}"


_RESULTS_SQL = f"""
results AS (
  SELECT table_name, check_type, status FROM ({_volume_sql()})
    WHERE table_name IN ('orders', 'lineitem', 'customer', 'events')
  UNION ALL SELECT 'part', 'volume', {_status("count(*) BETWEEN 100 AND 1000000")} FROM part
  UNION ALL SELECT table_name, 'range_checks', status FROM ({_range_sql(5.0)})
  UNION ALL {_latest("orders", "o_orderdate")}
  UNION ALL {_latest("lineitem", "l_shipdate")}
  UNION ALL {_latest("events", "ts")}
  UNION ALL SELECT 'customer', 'freshness', 'SKIP' FROM (SELECT count(*) FROM customer)
  UNION ALL SELECT 'part', 'freshness', 'SKIP' FROM (SELECT count(*) FROM part)),
checks AS (
  SELECT table_name, check_type, count(*) AS results, count(*) FILTER (status = 'FAIL') AS failed,
    CASE WHEN bool_or(status = 'FAIL') THEN 'FAIL' WHEN bool_or(status = 'ERROR') THEN 'ERROR'
         WHEN bool_and(status = 'SKIP') THEN 'SKIP' ELSE 'PASS' END AS status
  FROM results GROUP BY 1, 2)
"""


@query("rollup_check", f"WITH {_RESULTS_SQL} SELECT * FROM checks")
def rollup_check(spark, sf_dir):
    return rollup.rollup_checks(_table_results(spark, sf_dir))


# A table whose volume fails counts as one that could not be checked.
def _with_errors(results):
    failed_volume = (F.col("check_type") == "volume") & (F.col("status") == "FAIL")
    return results.withColumn("status", F.when(failed_volume, "ERROR").otherwise(F.col("status")))


_TABLES_SQL = f"""
{_RESULTS_SQL},
marked AS (
  SELECT table_name, CASE WHEN check_type = 'volume' AND status = 'FAIL' THEN 'ERROR' ELSE status END
    AS status FROM checks)
"""


def _tables_sql(first: str, second: str) -> str:
    return f"""SELECT table_name, count(*) AS checks,
      CASE WHEN bool_or(status = '{first}') THEN '{first}' WHEN bool_or(status = '{second}')
        THEN '{second}' ELSE 'PASS' END AS overall_status
    FROM marked GROUP BY table_name"""


@query("rollup_table_fail_first", f"WITH {_TABLES_SQL} {_tables_sql('FAIL', 'ERROR')}")
def rollup_table_fail_first(spark, sf_dir):
    merged = _with_errors(rollup.rollup_checks(_table_results(spark, sf_dir)))
    return rollup.rollup_tables(merged, rollup.FAIL_FIRST)


@query("rollup_table_error_first", f"WITH {_TABLES_SQL} {_tables_sql('ERROR', 'FAIL')}")
def rollup_table_error_first(spark, sf_dir):
    merged = _with_errors(rollup.rollup_checks(_table_results(spark, sf_dir)))
    return rollup.rollup_tables(merged, rollup.ERROR_FIRST)


@query(
    "rollup_run",
    f"""WITH {_TABLES_SQL}, tables AS ({_tables_sql("FAIL", "ERROR")})
        SELECT count(*) AS total_tables, count(*) FILTER (overall_status = 'PASS') AS successful_checks,
          count(*) FILTER (overall_status = 'FAIL') AS failed_checks,
          count(*) FILTER (overall_status = 'ERROR') AS error_checks FROM tables""",
)
def rollup_all(spark, sf_dir):
    merged = _with_errors(rollup.rollup_checks(_table_results(spark, sf_dir)))
    return rollup.rollup_run(rollup.rollup_tables(merged))
