"""Drift between runs."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.operators import drift, profile
from plumbline.queries import sql
from plumbline.queries.inputs import event_runs, yearly_orders
from plumbline.queries.registry import query, rounded, table
from plumbline.queries.sql import r

_STATS = (
    "total_rows",
    "null_count",
    "null_pct",
    "non_null_count",
    "distinct_count",
    "uniqueness_pct",
    "min_num",
    "max_num",
    "mean",
    "range_span",
    "stddev",
    "negative_count",
    "min_len",
    "max_len",
    "avg_len",
    "blank_count",
)


def _long_sql(name: str, by: str) -> str:
    parts = [
        f"SELECT run_id, table_name, column_name, '{s}' AS stat, CAST({s} AS DOUBLE) AS value "
        f"FROM p WHERE {s} IS NOT NULL"
        for s in _STATS
    ]
    return f"p AS ({sql.profile([name], by=by)}), long AS ({' UNION ALL '.join(parts)})"


_CHANGE = (
    "CASE WHEN o.value = 0 THEN CASE WHEN n.value = 0 THEN NULL ELSE 'inf'::DOUBLE END "
    f"ELSE {r('(n.value - o.value) / o.value * 100', 2)} END AS percent_change"
)
_JOINED = f"""SELECT o.run_id AS old_run, n.run_id AS new_run, o.table_name, o.column_name, o.stat,
      {r("o.value", 2)} AS old_value, {r("n.value", 2)} AS new_value, {_CHANGE}
    FROM long o JOIN long n ON o.table_name = n.table_name AND o.column_name = n.column_name
      AND o.stat = n.stat"""
_EVENT_DAY = "CAST(CAST(ts AS DATE) AS VARCHAR)"
_ORDER_YEAR = "CAST(year(o_orderdate) AS VARCHAR)"


def event_stats(spark, sf_dir):
    found = profile.column_profile(event_runs(spark, sf_dir), "events", by="run_id")
    return profile.profile_long(found, ("run_id", "table_name", "column_name"))


def _order_stats(spark, sf_dir):
    found = profile.column_profile(yearly_orders(spark, sf_dir), "orders", by="run_id")
    return profile.profile_long(found, ("run_id", "table_name", "column_name"))


def _shown(df):
    return rounded(df, 2, "old_value", "new_value", "percent_change")


@query(
    "drift_pair",
    f"WITH {_long_sql('orders', _ORDER_YEAR)} {_JOINED} WHERE o.run_id = '1996' AND n.run_id = '1997'",
)
def drift_pair(spark, sf_dir):
    return _shown(drift.drift_between(_order_stats(spark, sf_dir), "1996", "1997"))


_PAIRS = """pairs AS (
  SELECT old_run, new_run FROM (
    SELECT run_id AS old_run, lead(run_id) OVER (ORDER BY run_id) AS new_run
    FROM (SELECT DISTINCT run_id FROM long)) WHERE new_run IS NOT NULL)"""


@query(
    "drift_consecutive",
    f"""WITH {_long_sql('events', _EVENT_DAY)}, {_PAIRS} {_JOINED}
        JOIN pairs ON o.run_id = pairs.old_run AND n.run_id = pairs.new_run""",
)
def drift_consecutive(spark, sf_dir):
    runs = event_runs(spark, sf_dir).select("run_id")
    return _shown(drift.drift_consecutive(event_stats(spark, sf_dir), runs))


@query(
    "drift_empty",
    """SELECT count(*) FILTER (c_custkey IS NULL) AS compared,
         'No drift detected or no comparable columns found.' AS message FROM customer""",
)
def drift_empty(spark, sf_dir):
    """Two tables without a column in common."""
    old = profile.profile_long(profile.column_profile(table(spark, sf_dir, "customer"), "customer"))
    new = profile.profile_long(profile.column_profile(table(spark, sf_dir, "part"), "part"))
    return drift.drift_message(drift.drift_pair(old, new))


@query(
    "drift_sign",
    f"""WITH {_long_sql('orders', _ORDER_YEAR)}, {_PAIRS},
        d AS ({_JOINED} JOIN pairs ON o.run_id = pairs.old_run AND n.run_id = pairs.new_run)
        SELECT old_run, new_run,
          CASE WHEN percent_change < 0 THEN 'neg' WHEN percent_change >= 0 THEN 'pos' END AS direction,
          count(*) AS stats FROM d GROUP BY ALL""",
)
def drift_sign(spark, sf_dir):
    runs = yearly_orders(spark, sf_dir).select("run_id")
    found = _shown(drift.drift_consecutive(_order_stats(spark, sf_dir), runs))
    direction = drift.change_sign(F.col("percent_change")).alias("direction")
    return found.groupBy("old_run", "new_run", direction).agg(F.count(F.lit(1)).alias("stats"))

