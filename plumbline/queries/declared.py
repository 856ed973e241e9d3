"""Checks across tables and runs: references, keys, dates, sequences, alerts and monitoring."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from plumbline.functions.frames import union_all
from plumbline.operators import checks, integrity, profile, rollup, scoring, table_checks
from plumbline.plans.policy import Range, TableRules
from plumbline.plans.rules import evaluate_rules, packaged_rules
from plumbline.queries import sql
from plumbline.queries.inputs import PATCHY_ORDERS, POLICY, event_runs, source, sources
from plumbline.queries.registry import query, rounded, table
from plumbline.queries.rules import RUN_RESULTS_SQL, over_profile, run_results
from plumbline.queries.scores import SCORE_A_SQL
from plumbline.queries.sql import pct, r
from plumbline.sources import work_dir
from plumbline.streaming import judge_days, monitor_arrivals, watch
from plumbline.streaming.monitor import arrivals

AS_OF = "2024-02-02 00:00:00"


# --- rules from the configuration -----------------------------------------------------------


def _row(table_name, column, check, status, threshold, actual, latest="NULL") -> str:
    name = f"'{column}'" if column else "NULL"
    return f"""SELECT '{table_name}' AS table_name, CAST({name} AS VARCHAR) AS column_name,
      '{check}' AS check_type, CASE WHEN {status} THEN 'PASS' ELSE 'FAIL' END AS status,
      '{threshold}' AS threshold, CAST({actual} AS DOUBLE) AS actual,
      CAST({latest} AS VARCHAR) AS latest FROM {table_name}"""


def _config_sql() -> str:
    rows = [
        _row(t, None, "volume", f"count(*) BETWEEN {lo} AND {hi}", f"{lo}..{hi}", "count(*)")
        for t, lo, hi in (
            ("orders", 1000, 500000),
            ("lineitem", 1000, 30000),
            ("customer", 500, 250000),
            ("events", 100, 1000000),
            ("nation", 1, 1000000),
        )
    ]
    wrong = "count(*) FILTER (TRY_CAST(event_type AS INTEGER) IS NULL AND event_type IS NOT NULL)"
    rows.append(_row("events", "event_type", "castable", f"{wrong} = 0", "0 values that are no int", wrong))
    for t, c, parent, key, check in (
        ("orders", "o_custkey", "customer", "c_custkey", "foreign_key"),
        ("lineitem", "l_orderkey", "orders", "o_orderkey", "foreign_key"),
        ("customer", "c_nationkey", "nation", "n_nationkey", "lookup"),
    ):
        orphans = f"count({c}) FILTER ({c} NOT IN (SELECT {key} FROM {parent}))"
        rows.append(_row(t, c, check, f"{orphans} = 0", f"all in {parent}.{key}", orphans))
    rows.append(
        """SELECT 'lineitem', 'l_linenumber', 'sequence', CASE WHEN sum(gaps) = 0 THEN 'PASS' ELSE 'FAIL' END,
          '0 gaps', CAST(sum(gaps) AS DOUBLE), NULL FROM (SELECT l_orderkey, count(*) FILTER (step > 1) AS gaps
            FROM (SELECT l_orderkey, n - lag(n) OVER (PARTITION BY l_orderkey ORDER BY n) AS step
              FROM (SELECT DISTINCT l_orderkey, l_linenumber AS n FROM lineitem)) GROUP BY 1)"""
    )
    rows.append(
        """SELECT 'lineitem', 'l_shipdate', 'date_order',
          CASE WHEN count(*) FILTER (l_shipdate < o_orderdate) = 0 THEN 'PASS' ELSE 'FAIL' END,
          'not before orders.o_orderdate', CAST(count(*) FILTER (l_shipdate < o_orderdate) AS DOUBLE), NULL
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""
    )
    for t, c in (
        ("orders", "o_orderkey"),
        ("lineitem", "l_orderkey"),
        ("customer", "c_custkey"),
        ("events", "event_id"),
    ):
        share = pct(f"count(*) - count({c})", "count(*)")
        rows.append(_row(t, c, "null_checks", f"{share} <= 5", "<=5%", r(share, 2)))
    for t, c, lo, hi in (
        ("orders", "o_totalprice", 0, 400000),
        ("lineitem", "l_quantity", 1, 50),
        ("lineitem", "l_discount", 0, 0.05),
        ("customer", "c_acctbal", 0, 10000),
    ):
        share = pct(f"count(*) FILTER ({c} < {lo} OR {c} > {hi})", "count(*)")
        rows.append(_row(t, c, "range_checks", f"{share} <= 5", "<=5%", r(share, 2)))
    for t, c, pattern in (
        ("customer", "c_name", "^Customer#[0-9]{9}$"),
        ("events", "event_type", "^[a-z]+$"),
    ):
        broken = pct(f"count(*) FILTER (NOT regexp_matches({c}, '{pattern}'))", "count(*)")
        rows.append(_row(t, c, "pattern", f"{broken} = 0", "<=0%", r(broken, 2)))
    for t, key in (
        ("orders", "o_orderkey"),
        ("lineitem", "l_orderkey, l_linenumber"),
        ("customer", "c_custkey"),
        ("events", "event_id"),
        ("nation", "n_nationkey"),
    ):
        rows.append(
            f"""SELECT '{t}', '{key}', 'primary_key', CASE WHEN count(*) = 0 THEN 'PASS' ELSE 'FAIL' END,
              '0 duplicates', CAST(count(*) AS DOUBLE), NULL
            FROM (SELECT {key} FROM {t} GROUP BY {key} HAVING count(*) > 1)"""
        )
    rows.append(
        "SELECT 'customer', NULL, 'freshness', 'SKIP', '<=24h', CAST(NULL AS DOUBLE), NULL "
        "FROM (SELECT count(*) FROM customer)"
    )
    rows.append(
        "SELECT 'nation', NULL, 'freshness', 'SKIP', '<=24h', CAST(NULL AS DOUBLE), NULL "
        "FROM (SELECT count(*) FROM nation)"
    )
    for t, c, limit in (("orders", "o_orderdate", 24), ("events", "ts", 168), ("lineitem", "l_shipdate", 24)):
        hours = f"(epoch_us(TIMESTAMP '{AS_OF}') - epoch_us(max({c}))) / 3.6e9"
        latest = f"strftime(max({c}), '%Y-%m-%d %H:%M:%S')"
        rows.append(_row(t, c, "freshness", f"{hours} <= {limit}", f"<={limit}h", r(hours, 2), latest))
    return " UNION ALL ".join(rows)


CONFIG_SQL = _config_sql()


@query("rules_from_config", CONFIG_SQL)
def rules_from_config(spark, sf_dir):
    rules = packaged_rules("tpch")
    found = evaluate_rules(sources(spark, sf_dir, list(rules)), rules, AS_OF)
    return rounded(found, 2, "actual")


# --- references, keys, formats, dates -------------------------------------------------------

_REFERENCES = [
    ("lineitem", "l_orderkey", "orders", "o_orderkey"),
    ("orders", "o_custkey", "customer", "c_custkey"),
    ("documents", "doc_id", "labels", "doc_id"),
    ("lineitem", "l_suppkey", "supplier", "s_suppkey"),
    ("events", "user_id", "supplier", "s_suppkey"),
]


def _reference_sql(child: str, column: str, parent: str, key: str, check: str, parent_sql: str | None = None):
    orphan = f"count(*) FILTER (p.k IS NULL)"
    return f"""SELECT '{child}' AS table_name, '{column}' AS column_name, '{parent}' AS parent_table,
          '{check}' AS check_type, count(*) AS checked_rows, {orphan} AS orphan_rows,
          count(DISTINCT CASE WHEN p.k IS NULL THEN c.{column} END) AS orphan_keys,
          {r(pct(orphan, "count(*)"), 2)} AS orphan_pct,
          CASE WHEN {orphan} = 0 THEN 'PASS' ELSE 'FAIL' END AS status
        FROM {child} c LEFT JOIN (SELECT DISTINCT {key} AS k FROM {parent_sql or parent}) p
          ON c.{column} = p.k WHERE c.{column} IS NOT NULL"""


@query(
    "check_foreign_key",
    " UNION ALL ".join(_reference_sql(*ref, "foreign_key") for ref in _REFERENCES),
)
def check_foreign_key(spark, sf_dir):
    found = [
        integrity.reference_check(
            table(spark, sf_dir, child), column, table(spark, sf_dir, parent), key, child, parent
        )
        for child, column, parent, key in _REFERENCES
    ]
    return rounded(union_all(found), 2, "orphan_pct")


@query(
    "foreign_key_orphans",
    """SELECT e.user_id AS key_value, count(*) AS row_count FROM events e
       WHERE NOT EXISTS (SELECT 1 FROM supplier s WHERE s.s_suppkey = e.user_id) GROUP BY 1""",
)
def foreign_key_orphans(spark, sf_dir):
    events, suppliers = table(spark, sf_dir, "events"), table(spark, sf_dir, "supplier")
    return integrity.orphan_rows(events, "user_id", suppliers, "s_suppkey")


_BALANCED = "(SELECT c_mktsegment FROM customer GROUP BY 1 HAVING avg(c_acctbal) > 4450)"


@query(
    "check_lookup",
    _reference_sql("customer", "c_nationkey", "nation", "n_nationkey", "lookup")
    + " UNION ALL "
    + _reference_sql("customer", "c_mktsegment", "segments", "c_mktsegment", "lookup", _BALANCED)
    + " UNION ALL "
    + _reference_sql("nation", "n_regionkey", "region", "r_regionkey", "lookup"),
)
def check_lookup(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    segments = (
        customer.groupBy("c_mktsegment").agg(F.avg("c_acctbal").alias("mean")).where("mean > 4450")
    )
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    found = union_all(
        [
            integrity.reference_check(
                customer, "c_nationkey", nation, "n_nationkey", "customer", "nation", "lookup"
            ),
            integrity.reference_check(
                customer, "c_mktsegment", segments, "c_mktsegment", "customer", "segments", "lookup"
            ),
            integrity.reference_check(
                nation, "n_regionkey", region, "r_regionkey", "nation", "region", "lookup"
            ),
        ]
    )
    return rounded(found, 2, "orphan_pct")


_PATTERNS = {
    "customer": {"c_name": "^Customer#[0-9]{9}$", "c_mktsegment": "^[A-Z]+$"},
    "part": {"p_brand": "^Brand#[0-9]$", "p_name": "^[a-z]+ [a-z]+$"},
    "pages": {"url": "^https://"},
    "events": {"props": '^\\{"k": [0-9]+\\}$'},
}


@query(
    "check_pattern",
    f"""SELECT *, {r(pct("violations", "total_rows"), 2)} AS violation_pct,
          CASE WHEN violations = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM ("""
    + " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, '{p}' AS pattern, count(*) AS total_rows, "
        f"count(*) FILTER (NOT regexp_matches({c}, '{p}')) AS violations FROM {t}"
        for t, patterns in _PATTERNS.items()
        for c, p in patterns.items()
    )
    + ")",
)
def check_pattern(spark, sf_dir):
    found = [
        table_checks.pattern_checks(table(spark, sf_dir, t), t, patterns)
        for t, patterns in _PATTERNS.items()
    ]
    return rounded(union_all(found), 2, "violation_pct").drop("check_type")


@query(
    "check_date_order",
    f"""SELECT 'lineitem' AS table_name, 'l_shipdate >= o_orderdate' AS rule, count(*) AS checked_rows,
          count(*) FILTER (l_shipdate < o_orderdate) AS violations,
          {r(pct("count(*) FILTER (l_shipdate < o_orderdate)", "count(*)"), 2)} AS violation_pct,
          CASE WHEN count(*) FILTER (l_shipdate < o_orderdate) = 0 THEN 'PASS' ELSE 'FAIL' END AS status
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
)
def check_date_order(spark, sf_dir):
    found = integrity.date_order_check(
        table(spark, sf_dir, "lineitem"),
        table(spark, sf_dir, "orders"),
        ("l_orderkey", "o_orderkey"),
        "l_shipdate",
        "o_orderdate",
        "lineitem",
        spread_by=["l_linenumber", "l_partkey"],
    )
    return rounded(found, 2, "violation_pct").drop("check_type")


def _gaps_sql(name: str, position: str, group: str) -> str:
    return f"""SELECT '{name}' AS table_name, '{position}' AS column_name, count(*) AS sequences,
          count(*) FILTER (gaps > 0) AS broken_sequences, CAST(sum(gaps) AS BIGINT) AS gaps,
          CAST(sum(missing) AS BIGINT) AS missing_numbers,
          CASE WHEN sum(gaps) = 0 THEN 'PASS' ELSE 'FAIL' END AS status
        FROM (SELECT g, count(*) FILTER (step > 1) AS gaps, coalesce(sum(step - 1), 0) AS missing
          FROM (SELECT g, n - lag(n) OVER (PARTITION BY g ORDER BY n) AS step
            FROM (SELECT DISTINCT {group} AS g, {position} AS n FROM {name})) GROUP BY g)"""


@query(
    "check_sequence_gaps",
    _gaps_sql("lineitem", "l_linenumber", "l_orderkey")
    + " UNION ALL "
    + _gaps_sql("conversations", "turn", "conv_id")
    + " UNION ALL "
    + _gaps_sql("events", "event_id", "0"),
)
def check_sequence_gaps(spark, sf_dir):
    lineitem, events = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "events")
    turns = table(spark, sf_dir, "conversations")
    return union_all(
        [
            integrity.sequence_check(lineitem, "lineitem", "l_linenumber", "l_orderkey"),
            integrity.sequence_check(turns, "conversations", "turn", "conv_id"),
            integrity.sequence_check(events, "events", "event_id"),
        ]
    ).drop("check_type")


_KEYS = {
    "orders": ["o_orderkey"],
    "lineitem": ["l_orderkey", "l_linenumber"],
    "customer": ["c_custkey"],
    "documents": ["text"],
    "conversations": ["conv_id", "turn"],
}


@query(
    "check_primary_key",
    " UNION ALL ".join(
        f"""SELECT '{t}' AS table_name, '{", ".join(k)}' AS key_columns, CAST(sum(n) AS BIGINT) AS total_rows,
              count(*) AS distinct_keys, count(*) FILTER (n > 1) AS duplicate_keys,
              CAST(coalesce(sum(n) FILTER (n > 1), 0) AS BIGINT) AS duplicate_rows,
              CASE WHEN count(*) FILTER (n > 1) = 0 THEN 'PASS' ELSE 'FAIL' END AS status
            FROM (SELECT count(*) AS n FROM {t} GROUP BY {", ".join(k)})"""
        for t, k in _KEYS.items()
    ),
)
def check_primary_key(spark, sf_dir):
    found = [
        integrity.primary_key_check(table(spark, sf_dir, name), name, key)
        for name, key in _KEYS.items()
    ]
    return union_all(found).drop("check_type")


_NUMBERS = "SELECT event_id, json_extract_string(props, '$.k') AS k FROM events"


@query(
    "check_castable",
    f"""SELECT *, {r(pct("violations", "total_rows"), 2)} AS violation_pct,
          CASE WHEN violations = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM (
          SELECT 'events' AS table_name, 'k' AS column_name, 'int' AS expected_type,
            count(*) AS total_rows,
            count(*) FILTER (k IS NOT NULL AND TRY_CAST(k AS INTEGER) IS NULL) AS violations
          FROM ({_NUMBERS})
          UNION ALL SELECT 'events', 'event_type', 'double', count(*),
            count(*) FILTER (TRY_CAST(event_type AS DOUBLE) IS NULL) FROM events
          UNION ALL SELECT 'patchy_orders', 'o_note', 'date', count(*),
            count(*) FILTER (TRY_CAST(o_note AS DATE) IS NULL) FROM ({PATCHY_ORDERS})
          UNION ALL SELECT 'patchy_orders', 'o_open_status', 'int', count(*),
            count(*) FILTER (o_open_status IS NOT NULL AND TRY_CAST(o_open_status AS INTEGER) IS NULL)
          FROM ({PATCHY_ORDERS}))""",
)
def check_castable(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumn("k", F.get_json_object("props", "$.k"))
    patchy = source(spark, sf_dir, "patchy_orders")
    found = union_all(
        [
            table_checks.castable_checks(events, "events", {"k": "int", "event_type": "double"}),
            table_checks.castable_checks(
                patchy, "patchy_orders", {"o_note": "date", "o_open_status": "int"}
            ),
        ]
    )
    return rounded(found, 2, "violation_pct").drop("check_type")


@query(
    "quarantine_nulls",
    f"""SELECT accepted, null_columns, count(*) AS row_count FROM (
          SELECT o_open_status IS NOT NULL AND o_large_price IS NOT NULL AS accepted,
            concat_ws(', ', CASE WHEN o_open_status IS NULL THEN 'o_open_status' END,
              CASE WHEN o_large_price IS NULL THEN 'o_large_price' END) AS null_columns
          FROM ({PATCHY_ORDERS})) GROUP BY ALL""",
)
def quarantine_nulls(spark, sf_dir):
    patchy = source(spark, sf_dir, "patchy_orders")
    marked = table_checks.quarantine(patchy, ["o_open_status", "o_large_price"])
    return marked.groupBy("accepted", "null_columns").agg(F.count(F.lit(1)).alias("row_count"))


# --- runs -----------------------------------------------------------------------------------


@query(
    "check_volume_change",
    f"""WITH days AS (SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS n FROM events
          GROUP BY 1, 2),
        d AS (SELECT *, lag(n) OVER (PARTITION BY event_type ORDER BY day) AS expected FROM days)
        SELECT CAST(day AS VARCHAR) AS run_id, d.event_type AS table_name, n AS record_count,
          {r("expected", 2)} AS expected_count,
          CASE WHEN n = 0 THEN 'CRITICAL' WHEN n < expected * 0.5 THEN 'WARNING' ELSE 'PASS' END AS status,
          CASE WHEN n = 0 THEN 'Empty dataset detected' WHEN n < expected * 0.5
            THEN 'Volume below 50% of expected' ELSE 'Volume as expected' END AS message
        FROM d WHERE expected IS NOT NULL""",
)
def check_volume_change(spark, sf_dir):
    """Events per day and type against the day before, which is the run before."""
    days = (
        event_runs(spark, sf_dir)
        .groupBy("run_id", F.col("event_type").alias("table_name"))
        .agg(F.count(F.lit(1)).alias("record_count"))
    )
    # One row per run and type.
    before = F.lag("record_count").over(Window.partitionBy("table_name").orderBy("run_id"))
    known = days.withColumn("expected_count", before.cast("double")).where("expected_count IS NOT NULL")
    found = checks.volume_change_checks(known)
    return rounded(found, 2, "expected_count").drop("check_type")


_FAILED = "count(*) FILTER (status = 'FAIL')"


@query(
    "alert_failed_pct",
    f"""WITH {RUN_RESULTS_SQL}
        SELECT run_id, count(*) AS checks, {_FAILED} AS failed,
          {r(pct(_FAILED, "count(*)"), 2)} AS failed_pct, {pct(_FAILED, "count(*)")} > 25 AS alert
        FROM results GROUP BY run_id""",
)
def alert_failed_pct(spark, sf_dir):
    return rounded(rollup.failed_share_alert(run_results(spark, sf_dir)), 2, "failed_pct")


@query(
    "alert_consecutive",
    f"""WITH {RUN_RESULTS_SQL}, numbered AS (
          SELECT *, row_number() OVER (PARTITION BY table_name, check_type ORDER BY run_id)
            - row_number() OVER (PARTITION BY table_name, check_type, status ORDER BY run_id) AS g
          FROM results)
        SELECT table_name, check_type, min(run_id) AS first_run, max(run_id) AS last_run,
          count(*) AS failures
        FROM numbered WHERE status = 'FAIL' GROUP BY table_name, check_type, g HAVING count(*) >= 3""",
)
def alert_consecutive(spark, sf_dir):
    return rollup.consecutive_failures(run_results(spark, sf_dir))


@query(
    "retention_filter",
    f"""WITH {RUN_RESULTS_SQL} SELECT * FROM results
        WHERE CAST(run_id AS DATE) >= DATE '2024-02-14' - INTERVAL 30 DAY""",
)
def retention_filter(spark, sf_dir):
    return rollup.retained(run_results(spark, sf_dir), "run_id", "2024-02-14")


_DAY_PROFILE = sql.profile(["events"], by="CAST(CAST(ts AS DATE) AS VARCHAR)")
_DAY_SCORES_SQL = (
    over_profile(SCORE_A_SQL, f"SELECT run_id AS table_name, * EXCLUDE (table_name, run_id) FROM ({_DAY_PROFILE})")
    + """,
s AS (SELECT 'events' AS table_name, table_name AS run_id, avg(data_quality_score) AS mean_score
      FROM score_a GROUP BY 2)
"""
)


def _day_scores(spark, sf_dir):
    """The scores that an assessment of each day of events gives its columns."""
    profiled = profile.column_profile(
        event_runs(spark, sf_dir), "events", by="run_id", stats=profile.WITHOUT_SPREAD
    )
    return scoring.score_alerts(checks.with_findings(profiled, POLICY))


@query(
    "score_trend",
    f"""{_DAY_SCORES_SQL}
        SELECT table_name, run_id, {r("mean_score", 2)} AS mean_score,
          {r("mean_score - lag(mean_score) OVER (PARTITION BY table_name ORDER BY run_id)", 2)}
            AS score_change,
          {r("avg(mean_score) OVER (PARTITION BY table_name ORDER BY run_id "
             "ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)", 2)} AS moving_score
        FROM s""",
)
def score_trend(spark, sf_dir):
    scored = _day_scores(spark, sf_dir)
    return rounded(rollup.score_trend(scored), 2, "mean_score", "score_change", "moving_score")


_SLACK, _LIMIT = 0.1, 0.5
_OFF = "CASE WHEN w.n = 0 THEN 0 ELSE x.mean_score - w.mean END"
_UP = f"greatest(0, w.up + {_OFF} - {_SLACK})"
_DOWN = f"greatest(0, w.down - ({_OFF}) - {_SLACK})"
_OVER = f"({_UP} > {_LIMIT} OR {_DOWN} > {_LIMIT})"


@query(
    "score_changes",
    f"""{_DAY_SCORES_SQL.replace("WITH", "WITH RECURSIVE", 1)},
        x AS (SELECT *, row_number() OVER (PARTITION BY table_name ORDER BY run_id) AS i FROM s),
        w(table_name, i, n, mean, up, down, shift_up, shift_down, changed) AS (
          SELECT DISTINCT table_name, 0::BIGINT, 0::BIGINT, 0::DOUBLE, 0::DOUBLE, 0::DOUBLE, 0::DOUBLE, 0::DOUBLE,
            false FROM x
          UNION ALL
          SELECT x.table_name, x.i, CASE WHEN {_OVER} THEN 1 ELSE w.n + 1 END,
            CASE WHEN {_OVER} THEN x.mean_score ELSE w.mean + (x.mean_score - w.mean) / (w.n + 1) END,
            CASE WHEN {_OVER} THEN 0 ELSE {_UP} END, CASE WHEN {_OVER} THEN 0 ELSE {_DOWN} END, {_UP}, {_DOWN}, {_OVER}
          FROM w JOIN x ON x.table_name = w.table_name AND x.i = w.i + 1)
        SELECT x.table_name, x.run_id, {r("x.mean_score", 2)} AS mean_score, {r("w.shift_up", 2)} AS shift_up,
          {r("w.shift_down", 2)} AS shift_down, w.changed
        FROM w JOIN x ON x.table_name = w.table_name AND x.i = w.i""",
)
def score_changes(spark, sf_dir):
    """Days on which the score of events has shifted from that of the days before."""
    scores = rollup.score_trend(_day_scores(spark, sf_dir))
    return rounded(rollup.change_points(scores, _SLACK, _LIMIT), 2, "mean_score", "shift_up", "shift_down")


@query(
    "expected_volume",
    f"""WITH c AS (SELECT event_type AS table_name, CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY 1, 2),
        b AS (SELECT c.table_name, c.day, c.n, p.n AS before FROM c LEFT JOIN c p
          ON p.table_name = c.table_name AND p.day < c.day AND dayofweek(p.day) = dayofweek(c.day)),
        m AS (SELECT table_name, day, any_value(n) AS n, count(before) AS k, median(before) AS middle FROM b GROUP BY 1, 2),
        d AS (SELECT m.table_name, m.day, any_value(m.n) AS n, any_value(k) AS k, any_value(middle) AS middle,
            greatest(1, 1.4826 * median(abs(before - middle))) AS spread
          FROM m JOIN b ON b.table_name = m.table_name AND b.day = m.day GROUP BY 1, 2)
        SELECT table_name, CAST(day AS VARCHAR) AS run_id, n AS record_count, CAST(k AS INTEGER) AS earlier_runs,
          CASE WHEN k >= 3 THEN {r("middle", 2)} END AS expected_count, CASE WHEN k >= 3 THEN {r("spread", 2)} END AS spread,
          CASE WHEN k < 3 THEN 'SKIP' WHEN abs(n - middle) > 2 * spread THEN 'FAIL' ELSE 'PASS' END AS status
        FROM d""",
)
def expected_volume(spark, sf_dir):
    """Events per day and type against the same weekday of the weeks before."""
    counts = (
        event_runs(spark, sf_dir)
        .groupBy("run_id", F.col("event_type").alias("table_name"))
        .agg(F.count(F.lit(1)).alias("record_count"))
        .withColumn("run_date", F.col("run_id"))
    )
    return rounded(rollup.expected_volumes(counts, deviations=2.0), 2, "expected_count", "spread")


# --- newly arrived data ---------------------------------------------------------------------

_DAY_VOLUME = Range(320, 345)


@query(
    "stream_daily_checks",
    f"""SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, count(*) AS record_count,
          count(*) FILTER (value IS NULL) AS null_count,
          count(*) FILTER (value < 0 OR value > 100) AS violations,
          min(value) AS min_value, max(value) AS max_value,
          CASE WHEN count(*) BETWEEN 320 AND 345 THEN 'PASS' ELSE 'FAIL' END AS volume_status,
          'PASS' AS null_status,
          CASE WHEN {pct("count(*) FILTER (value < 0 OR value > 100)", "count(*)")} <= 12.5
            THEN 'PASS' ELSE 'FAIL' END AS range_status
        FROM events GROUP BY 1""",
)
def stream_daily_checks(spark, sf_dir):
    schema = table(spark, sf_dir, "events").schema
    stream = arrivals(spark.readStream.schema(schema), f"{sf_dir}/events.parquet")
    out, state = work_dir(spark, "arrivals"), work_dir(spark, "arrivals-state")
    figures = monitor_arrivals(stream, out, state, "ts", "value", Range(0, 100))
    days = judge_days(figures, _DAY_VOLUME, 12.5)
    return days.withColumn("day", F.col("day").cast("string"))


_WATCHED = TableRules(
    volume=Range(320, 345),
    critical=("event_id",),
    ranges={"value": Range(0, 100)},
    range_tolerance_pct=12.5,
    patterns={"event_type": "^(?:click|view|signup|purchase)$"},
    pattern_tolerance_pct=20.0,
    types={"event_type": "int"},
    primary_key=("event_id",),
    freshness_hours=None,
)


def _watched_sql() -> str:
    far, wrong = "count(*) FILTER (value < 0 OR value > 100)", "count(*) FILTER (event_type = 'error')"
    text = "count(*) FILTER (TRY_CAST(event_type AS INTEGER) IS NULL)"
    rows = [
        ("NULL", "volume", "count(*) BETWEEN 320 AND 345", "320..345", "count(*)"),
        ("'event_id'", "null_checks", "count(event_id) = count(*)", "<=5%", pct("count(*) - count(event_id)", "count(*)")),
        ("'value'", "range_checks", f"{pct(far, 'count(*)')} <= 12.5", "<=12.5%", pct(far, "count(*)")),
        ("'event_type'", "pattern", f"{pct(wrong, 'count(*)')} <= 20", "<=20%", pct(wrong, "count(*)")),
        ("'event_type'", "castable", f"{text} = 0", "0 values that are no int", text),
    ]
    days = """(SELECT *, CAST(ts AS DATE) AS day,
      CAST(ts AS DATE) + INTERVAL 1 DAY + INTERVAL 48 HOUR <= (SELECT max(ts) FROM events) AS final FROM events)"""
    parts = [
        f"""SELECT CAST(day AS VARCHAR) AS day, 'events' AS table_name, final, 0::BIGINT AS late_rows,
          CAST({column} AS VARCHAR) AS column_name, '{check}' AS check_type,
          CASE WHEN {passed} THEN 'PASS' ELSE 'FAIL' END AS status, '{threshold}' AS threshold,
          {r(f"CAST({actual} AS DOUBLE)", 2)} AS actual FROM {days} GROUP BY day, final"""
        for column, check, passed, threshold, actual in rows
    ]
    repeated = "count(*) > count(DISTINCT event_id)"
    parts.append(
        f"""SELECT CAST(day AS VARCHAR), 'events', final, 0, NULL, 'primary_key',
          CASE WHEN {repeated} THEN 'FAIL' ELSE 'PASS' END, '<=4.88% repeated, estimated', NULL
        FROM {days} GROUP BY day, final"""
    )
    return " UNION ALL ".join(parts)


@query("watch_rules", _watched_sql())
def watch_rules(spark, sf_dir):
    """Configured rules over events that arrive in several batches; the estimate of repeated keys, which
    follows from sketches, is left out."""
    arrived, events = work_dir(spark, "watched"), table(spark, sf_dir, "events")
    # A part of the time for each arrival; days lie on both sides of the borders.
    first, last = events.agg(F.min("ts"), F.max("ts")).first()
    borders = [first, first + (last - first) / 3, first + (last - first) * 2 / 3, last]
    out = work_dir(spark, "watch")
    for i, (low, high) in enumerate(zip(borders, borders[1:])):
        part = events.where((F.col("ts") >= low) & ((F.col("ts") < high) if i < 2 else (F.col("ts") <= high)))
        part.write.mode("append").parquet(arrived)
        # All files of an arrival are one batch.
        days = watch(spark, {"events": arrived}, {"events": _WATCHED}, out, 48)
    estimated = F.col("check_type") == "primary_key"
    found = days.withColumns(
        {"day": F.col("day").cast("string"), "actual": F.when(~estimated, F.col("actual"))}
    )
    return rounded(found, 2, "actual")
