"""Whole runs: written to files, and read back."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from plumbline.functions import half_up
from plumbline.plans.checking import run_checks, stored_run
from plumbline.plans.daily import batch_drift, run_daily
from plumbline.plans.policy import Range, TableRules
from plumbline.plans.publishing import REJECTED, published, rejected_by
from plumbline.plans.rules import packaged_rules
from plumbline.plans.simulate import write_snapshots
from plumbline.queries import sql
from plumbline.queries.declared import AS_OF, CONFIG_SQL
from plumbline.queries.inputs import ASSESSED, PATCHY_ORDERS, POLICY, source, sources
from plumbline.queries.registry import query, rounded, table
from plumbline.queries.rules import FINDINGS_SQL, over_profile
from plumbline.queries.scores import SCORE_A_SQL
from plumbline.queries.snapshots import DAY, RATES, sampled
from plumbline.queries.sql import r
from plumbline.sources import load_each, work_dir
from plumbline.sources.lanes import read_lanes


@query(
    "daily_run",
    FINDINGS_SQL
    + """SELECT table_name, column_name, 'alert' AS record, check_type, severity,
           CAST(NULL AS VARCHAR) AS status FROM alerts
         UNION ALL SELECT table_name, column_name, 'check', check_type, NULL, status FROM checks""",
)
def daily_run(spark, sf_dir):
    """Assess the tables, write all reports, and read the findings."""
    paths = run_daily(
        sources(spark, sf_dir, ASSESSED),
        work_dir(spark, "daily"),
        "20240131_000000",
        "2024-01-31T00:00:00",
        POLICY,
    )
    return spark.read.parquet(paths["findings"]).select(
        "table_name", "column_name", "record", "check_type", "severity", "status"
    )


@query(
    "check_run",
    f"""WITH results AS ({CONFIG_SQL}),
        checks AS (SELECT table_name, check_type,
            CASE WHEN bool_or(status = 'FAIL') THEN 'FAIL' WHEN bool_and(status = 'SKIP') THEN 'SKIP'
                 ELSE 'PASS' END AS status FROM results GROUP BY 1, 2)
        SELECT table_name, count(*) AS checks,
          CASE WHEN bool_or(status = 'FAIL') THEN 'FAIL' ELSE 'PASS' END AS overall_status
        FROM checks GROUP BY 1
        UNION ALL SELECT 'returns', 0, 'SKIPPED' FROM (SELECT count(*) FROM orders)""",
)
def check_run(spark, sf_dir):
    """Evaluate the configured rules, write results and statuses, and read the statuses."""
    rules = packaged_rules("tpch")
    refs = {name: f"{sf_dir}/{name}.parquet" for name in [*rules, "returns"]}
    everything = {**rules, "returns": TableRules()}
    paths = run_checks(spark, refs, everything, work_dir(spark, "checks"), "1", AS_OF)
    schema = "table_name string, checks bigint, overall_status string"
    return spark.read.schema(schema).option("header", True).csv(paths["tables"])


_ISOLATED = """
WITH results AS ({config}), kept AS (
  SELECT table_name, column_name, check_type,
    CASE check_type WHEN 'lookup' THEN 'SKIP' ELSE status END AS status FROM results WHERE table_name = 'customer'
  UNION ALL SELECT 'customer', 'c_name', 'range_checks', 'ERROR' FROM (SELECT count(*) FROM customer)
  UNION ALL SELECT 'broken', NULL, 'evaluation', 'ERROR' FROM (SELECT count(*) FROM customer))
SELECT * FROM kept
"""


@query("check_run_isolated", _ISOLATED.format(config=CONFIG_SQL))
def check_run_isolated(spark, sf_dir):
    """A rule that cannot be judged, and a source that cannot be read, beside rules that can."""
    rule = packaged_rules("tpch")["customer"]
    ranges = {c: limit for c, limit in rule.ranges.items() if c.startswith("c_")}
    # The names are texts that are no numbers: their comparison fails on its first row.
    raising = replace(
        rule,
        ranges={"c_name": Range(0, 1), **ranges},
        patterns={"c_name": rule.patterns["c_name"]},
        critical=("c_custkey",),
        general=False,
    )
    spoiled = work_dir(spark, "spoiled")
    table(spark, sf_dir, "region").select("r_name").write.text(spoiled)
    refs = {"customer": f"{sf_dir}/customer.parquet", "broken": f"{spoiled}/*.txt"}
    paths = run_checks(spark, refs, {"customer": raising, "broken": TableRules()}, work_dir(spark, "checks"), "1", AS_OF)
    results = stored_run(spark, paths)
    return results.select("table_name", "column_name", "check_type", "status")


_TOLD = """CASE WHEN actual IS NOT NULL THEN ' - ' || printf('%.2f', ACTUAL) || ' against ' || threshold
  WHEN threshold IS NOT NULL THEN ' - ' || threshold ELSE '' END""".replace("ACTUAL", r("actual", 2))


@query(
    "rule_summary",
    f"""WITH results AS ({CONFIG_SQL}),
        checks AS (SELECT table_name, check_type,
            CASE WHEN bool_or(status = 'FAIL') THEN 'FAIL' WHEN bool_and(status = 'SKIP') THEN 'SKIP'
                 ELSE 'PASS' END AS status FROM results GROUP BY 1, 2),
        tables AS (SELECT table_name, CASE WHEN bool_or(status = 'FAIL') THEN 'FAIL' ELSE 'PASS' END AS overall
          FROM checks GROUP BY 1 UNION ALL SELECT 'returns', 'SKIPPED' FROM (SELECT count(*) FROM orders)),
        head AS (SELECT unnest([repeat('=', 80), 'DATA QUALITY REPORT', repeat('=', 80), 'Generated: {AS_OF}',
            'Tables Processed: ' || count(*), 'Successful: ' || count(*) FILTER (overall = 'PASS'),
            'Failed: ' || count(*) FILTER (overall = 'FAIL'), 'Errors: ' || count(*) FILTER (overall = 'ERROR'),
            'Skipped: ' || count(*) FILTER (overall = 'SKIPPED'), repeat('=', 80)]) AS line FROM tables)
        SELECT line FROM head
        UNION ALL SELECT unnest(['TABLE: ' || table_name, repeat('-', 60), '   Overall Status: ' || overall]) FROM tables
        UNION ALL SELECT '   ' || check_type || coalesce(' ' || column_name, '') || ': ' || status || {_TOLD} FROM results""",
)
def rule_summary(spark, sf_dir):
    """The text summary of a rule run, line by line as it was written."""
    rules = packaged_rules("tpch")
    refs = {name: f"{sf_dir}/{name}.parquet" for name in [*rules, "returns"]}
    everything = {**rules, "returns": TableRules()}
    paths = run_checks(spark, refs, everything, work_dir(spark, "summary"), "1", AS_OF)
    return spark.read.text(paths["summary"]).withColumnRenamed("value", "line")


_BROKEN_LINES = "o_orderkey % 97 = 0"


@query(
    "malformed_rows",
    f"""SELECT 'kept' AS lane, CAST(NULL AS VARCHAR) AS record, count(*) AS row_count,
          CAST(sum(o_custkey) AS BIGINT) AS custkeys, {r("avg(o_totalprice)", 2)} AS mean_price,
          'bigint,int,string,double,timestamp' AS types FROM orders WHERE NOT {_BROKEN_LINES}
        UNION ALL SELECT 'broken', o_orderkey || ',broken', 1, NULL, NULL, NULL FROM orders WHERE {_BROKEN_LINES}
        UNION ALL SELECT 'error', count(*) || ' lines that do not fit the header', 1, NULL, NULL, NULL
          FROM orders WHERE {_BROKEN_LINES} HAVING count(*) > 0""",
)
def malformed_rows(spark, sf_dir):
    """Orders as CSV with lines that lack columns: what is kept, with its types, and what is set aside."""
    path, orders = f"{work_dir(spark, 'lanes')}.csv", table(spark, sf_dir, "orders")
    wide = F.col("o_orderkey") + F.lit(1 << 40)
    whole = F.concat_ws(
        ",", wide, "o_custkey", F.concat(F.lit("x"), "o_orderstatus"), F.col("o_totalprice"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"),
    )
    line = F.when(F.expr(_BROKEN_LINES), F.concat("o_orderkey", F.lit(",broken"))).otherwise(whole)
    # Each task writes its lines with the header first; the whole line is one field of the writer.
    lines = orders.select(line.alias("key,cust,status,price,day"))
    lines.write.csv(path, header=True, sep="\x01", quote="")
    rules = {"orders": TableRules(volume=Range(1, 10**9), freshness_hours=None)}
    paths = run_checks(spark, {"orders": path}, rules, work_dir(spark, "lanes"), "1", AS_OF)
    good, _ = read_lanes(spark, path)
    kept = good.agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("cust").alias("custkeys"), half_up(F.avg("price"), 2).alias("mean_price")
    ).selectExpr(
        "'kept' AS lane", "CAST(NULL AS STRING) AS record", "*", f"'{','.join(t for _, t in good.dtypes)}' AS types"
    )
    aside = spark.read.parquet(f"{paths['malformed']}/source=orders").selectExpr("'broken' AS lane", "record")
    error = stored_run(spark, paths).where("status = 'ERROR'").selectExpr("'error' AS lane", "message AS record")
    both = aside.unionByName(error).selectExpr(
        "*", "1L AS row_count", "CAST(NULL AS BIGINT) AS custkeys", "CAST(NULL AS DOUBLE) AS mean_price", "CAST(NULL AS STRING) AS types"
    )
    return kept.unionByName(both)


@query(
    "published_rows",
    f"""WITH p AS ({PATCHY_ORDERS}), m AS (SELECT
            CASE WHEN o_orderkey IS NULL THEN 1 ELSE 0 END + CASE WHEN o_open_status IS NULL THEN 2 ELSE 0 END
            + CASE WHEN o_large_price IS NULL THEN 4 ELSE 0 END AS reasons, o_totalprice,
            concat_ws(', ', CASE WHEN o_orderkey IS NULL THEN 'o_orderkey' END,
              CASE WHEN o_open_status IS NULL THEN 'o_open_status' END,
              CASE WHEN o_large_price IS NULL THEN 'o_large_price' END) AS null_columns FROM p)
        SELECT CASE WHEN reasons = 0 THEN 'accepted' ELSE 'rejected' END AS verdict, CAST(reasons AS BIGINT) AS reasons,
          null_columns, count(*) AS row_count FROM m GROUP BY ALL""",
)
def published_rows(spark, sf_dir):
    """A rule run that stores accepted and rejected rows, read back through its manifest."""
    out, columns = work_dir(spark, "published"), ("o_orderkey", "o_open_status", "o_large_price")
    path = work_dir(spark, "patchy")
    source(spark, sf_dir, "patchy_orders").write.parquet(path)
    rules = {"orders": TableRules(critical=columns, freshness_hours=None)}
    run_checks(spark, {"orders": path}, rules, out, "20240131_000000", AS_OF, split_rows=True)
    rows = f"{out}/rows/orders"
    rejected = rejected_by(published(spark, rows, "20240131_000000", REJECTED), list(columns))
    accepted = published(spark, rows, "20240131_000000").agg(F.count(F.lit(1)).alias("row_count"))
    return accepted.selectExpr("'accepted' AS verdict", "0L AS reasons", "'' AS null_columns", "row_count").unionByName(
        rejected.withColumn("verdict", F.lit(REJECTED))
    )


_SPLIT_COLUMNS = ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"]


@query(
    "daily_run_isolated",
    " UNION ALL ".join(
        f"SELECT 'part' AS table_name, '{c}' AS column_name, {i} AS ordinal, count(*) AS total_rows, "
        f"CAST(count(*) - count({c}) AS BIGINT) AS null_count, count(DISTINCT {c}) AS distinct_count, NULL AS error FROM part"
        for i, c in enumerate(_SPLIT_COLUMNS)
    )
    + " UNION ALL SELECT 'part', 'p_number', NULL, NULL, NULL, NULL, 'CAST_INVALID_INPUT' FROM (SELECT count(*) FROM part)"
    + " UNION ALL SELECT 'returns', 'ERROR', NULL, NULL, NULL, NULL, 'PATH_NOT_FOUND' FROM (SELECT count(*) FROM part)",
)
def daily_run_isolated(spark, sf_dir):
    """A column that raises and a source that is missing: each is one row of errors, all else is assessed."""
    refs = {"part": f"{sf_dir}/part.parquet", "returns": f"{sf_dir}/returns.parquet"}
    tables, failed = load_each(spark, refs)
    tables["part"] = tables["part"].withColumn("p_number", F.col("p_name").cast("int"))
    paths = run_daily(tables, work_dir(spark, "isolated"), "1", "2024-01-31", POLICY, failed=failed)
    detail = spark.read.option("header", True).csv(paths["detail"])
    broken = detail.where("data_type IS NULL").selectExpr(
        "table_name", "column_name", "CAST(NULL AS INT) AS ordinal", "CAST(NULL AS BIGINT) AS total_rows",
        "CAST(NULL AS BIGINT) AS null_count", "CAST(NULL AS BIGINT) AS distinct_count", "issues AS error",
    )
    assessed = spark.read.schema(
        "table_name string, column_name string, ordinal int, total_rows bigint, null_count bigint, distinct_count bigint"
    ).parquet(f"{paths['assessment']}/source=part")
    return assessed.withColumn("error", F.lit(None).cast("string")).unionByName(broken)


_DOCUMENT_STATS = {
    "total_rows": "total_rows",
    "null_count": "null_count",
    "null_percentage": r("null_pct", 2),
    "non_null_count": "non_null_count",
    "distinct_count": "distinct_count",
    "uniqueness_percentage": r("uniqueness_pct", 2),
    "min_value": "min_num",
    "max_value": "max_num",
    "average_value": r("mean", 2),
    "range_span": "range_span",
    "min_length": "min_len",
    "max_length": "max_len",
    "avg_length": r("avg_len", 2),
}


def _stats_sql(name: str) -> str:
    return " UNION ALL ".join(
        f"SELECT column_name, '{stat}' AS stat, CAST({e} AS DOUBLE) AS value FROM ({sql.profile([name])})"
        for stat, e in _DOCUMENT_STATS.items()
    )


def _score_of(name: str) -> str:
    return f"""UNION ALL SELECT column_name, 'data_quality_score', CAST(data_quality_score AS DOUBLE) FROM score_a
      WHERE table_name = '{name}'"""


@query(
    "drift_documents",
    f"""{over_profile(SCORE_A_SQL, sql.profile(["customer", "funded_customers"]))},
        o AS ({_stats_sql("customer")} {_score_of("customer")}),
        n AS ({_stats_sql("funded_customers")} {_score_of("funded_customers")})
        SELECT '20240130_000000' AS old_run, '20240131_000000' AS new_run, 'customer' AS table_name,
          o.column_name, o.stat, {r("o.value", 2)} AS old_value, {r("n.value", 2)} AS new_value,
          CASE WHEN o.value = 0 THEN CASE WHEN n.value = 0 THEN NULL ELSE 'inf'::DOUBLE END
            ELSE {r("(n.value - o.value) / o.value * 100", 2)} END AS percent_change
        FROM o JOIN n ON o.column_name = n.column_name AND o.stat = n.stat
        WHERE o.value IS NOT NULL AND n.value IS NOT NULL""",
)
def drift_documents(spark, sf_dir):
    """Two runs written as documents, and the drift between them."""
    out = work_dir(spark, "drift")
    found = sources(spark, sf_dir, ["customer", "funded_customers"])
    for name, run in (("customer", "20240130_000000"), ("funded_customers", "20240131_000000")):
        run_daily({"customer": found[name]}, out, run, run, POLICY)
    return rounded(batch_drift(spark, out), 2, "old_value", "new_value", "percent_change")


@query(
    "snapshot_run",
    " UNION ALL ".join(
        f"SELECT '{t}_daily' AS table_name, 'success' AS status, count(*) AS record_count, NULL AS message "
        f"FROM {t} WHERE {sampled(key, rate)}"
        for t, (key, rate) in RATES.items()
    )
    + " UNION ALL SELECT 'returns_daily', 'error', NULL, 'PATH_NOT_FOUND' FROM (SELECT count(*) FROM orders)",
)
def snapshot_run(spark, sf_dir):
    """Store the samples of a day; the run goes on past a missing source."""
    names = [*RATES, "returns"]
    refs = {name: f"{sf_dir}/{name}.parquet" for name in names}
    keys = {name: key for name, (key, _) in RATES.items()} | {"returns": "id"}
    rates = {name: rate for name, (_, rate) in RATES.items()}
    results = write_snapshots(spark, refs, keys, DAY, work_dir(spark, "snapshots"), rates)
    return results

