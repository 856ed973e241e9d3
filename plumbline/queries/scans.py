"""Scans and sinks."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from plumbline.functions.frames import union_all
from plumbline.functions import business_columns, column_specs
from plumbline.operators import table_checks
from plumbline.operators.snapshot import stamp_metadata
from plumbline.plans.policy import Range
from plumbline.queries.inputs import SCHEMAS, TABLES, source
from plumbline.queries.registry import query, rounded, table
from plumbline.queries.sql import pct, r
from plumbline.sources import (
    append_table,
    csv_schema,
    export_tables,
    load_table,
    load_tables,
    overwrite_partitions,
    read_csv,
    read_view,
    table_inventory,
    work_dir,
    write_csv,
)

AS_OF = "2024-01-31 00:00:00"


@query(
    "scan_parquet",
    f"""SELECT l_returnflag, l_linestatus, count(*) AS line_count,
          {r("sum(CAST(l_extendedprice AS DECIMAL(18,2)))", 2)} AS sum_price
        FROM lineitem WHERE l_shipdate >= TIMESTAMP '1998-01-01' GROUP BY ALL""",
)
def scan_parquet(spark, sf_dir):
    lineitem = load_table(spark, f"{sf_dir}/lineitem.parquet", table_format="iceberg")
    return (
        lineitem.where(F.col("l_shipdate") >= F.lit("1998-01-01").cast("timestamp_ntz"))
        .groupBy("l_returnflag", "l_linestatus")
        .agg(
            F.count(F.lit(1)).alias("line_count"),
            F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double").alias("sum_price"),
        )
    )


@query(
    "scan_csv_roundtrip",
    f"""SELECT o_orderstatus, o_orderpriority, count(*) AS order_count,
          count(DISTINCT o_custkey) AS customers, min(o_orderkey) AS first_key,
          {r("sum(CAST(o_totalprice AS DECIMAL(18,2)))", 2)} AS sum_price,
          CAST(CAST(max(o_orderdate) AS DATE) AS VARCHAR) AS last_date
        FROM orders GROUP BY ALL""",
)
def scan_csv_roundtrip(spark, sf_dir):
    path = work_dir(spark, "orders-csv")
    table(spark, sf_dir, "orders").write.option("header", True).csv(path)
    orders = read_csv(spark, path, csv_schema(spark, path))
    return orders.groupBy("o_orderstatus", "o_orderpriority").agg(
        F.count(F.lit(1)).alias("order_count"),
        F.count_distinct("o_custkey").alias("customers"),
        F.min(F.col("o_orderkey").cast("bigint")).alias("first_key"),
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("sum_price"),
        F.max(F.col("o_orderdate").cast("date")).cast("string").alias("last_date"),
    )


@query(
    "table_volumes",
    " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS record_count FROM {t}" for t in TABLES),
)
def table_volumes(spark, sf_dir):
    tables = load_tables(spark, sf_dir, TABLES)
    return union_all([table_checks.row_counts(df, name) for name, df in tables.items()])


@query(
    "table_inventory",
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, true AS table_exists, count(*) AS record_count, "
        f"'FOUND' AS status, 'Table found' AS message FROM {t}"
        for t in TABLES
    )
    + " UNION ALL SELECT 'returns', false, 0, 'SKIPPED', 'Table not found'",
)
def inventory(spark, sf_dir):
    names = [*TABLES, "returns"]
    return table_inventory(spark, {name: f"{sf_dir}/{name}.parquet" for name in names})


@query(
    "table_shape",
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS total_rows, "
        f"CAST({len(SCHEMAS[t]) + 5} AS INTEGER) AS total_columns, "
        f"CAST({len(SCHEMAS[t])} AS INTEGER) AS business_columns FROM {t}"
        for t in TABLES
    ),
)
def table_shape(spark, sf_dir):
    parts = []
    for name, df in load_tables(spark, sf_dir, TABLES).items():
        daily = stamp_metadata(df, name, "2024-01-31", as_of=AS_OF)
        parts.append(
            daily.agg(F.count(F.lit(1)).alias("total_rows")).select(
                F.lit(name).alias("table_name"),
                "total_rows",
                F.lit(len(daily.columns)).alias("total_columns"),
                F.lit(len(column_specs(daily))).alias("business_columns"),
            )
        )
    return union_all(parts)


@query("view_roundtrip", "SELECT c_mktsegment, count(*) AS customers FROM customer GROUP BY ALL")
def view_roundtrip(spark, sf_dir):
    view = read_view(table(spark, sf_dir, "customer"), "customer_daily")
    return view.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("customers"))


_DAILY_COUNTS = "SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS ingestion_date, {count} AS events FROM events"


def _dated_events(spark, sf_dir):
    return table(spark, sf_dir, "events").withColumn(
        "ingestion_date", F.to_date("ts").cast("string")
    )


def _counts_by_day(df):
    day = F.col("ingestion_date").cast("date").cast("string").alias("ingestion_date")
    return df.groupBy(day).agg(F.count(F.lit(1)).alias("events"))


@query("append_snapshot", _DAILY_COUNTS.format(count="2 * count(*)") + " GROUP BY ALL")
def append_snapshot(spark, sf_dir):
    """Two appends, the first of which creates the table."""
    path, name = work_dir(spark, "events-daily"), f"events_daily_{uuid.uuid4().hex}"
    events = _dated_events(spark, sf_dir)
    append_table(events, name, path)
    append_table(events, name, path)
    spark.sql(f"DROP TABLE {name}")  # the files stay: the table is external
    return _counts_by_day(spark.read.parquet(path))


@query("overwrite_snapshot", _DAILY_COUNTS.format(count="count(*)") + " GROUP BY ALL")
def overwrite_snapshot(spark, sf_dir):
    """Writing the same days twice leaves one copy."""
    path = work_dir(spark, "events-overwrite")
    events = _dated_events(spark, sf_dir)
    overwrite_partitions(events, path)
    return _counts_by_day(overwrite_partitions(events, path))


@query(
    "export_tables",
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS record_count, 'EXPORTED' AS status, '' AS message FROM {t}"
        for t in ("customer", "supplier", "part", "orders")
    )
    + " UNION ALL SELECT 'returns', 0, 'ERROR', 'PATH_NOT_FOUND'",
)
def export(spark, sf_dir):
    names = ("customer", "supplier", "part", "orders", "returns")
    refs = {name: f"{sf_dir}/{name}.parquet" for name in names}
    return export_tables(spark, refs, work_dir(spark, "export"))


@query(
    "export_check_csv",
    f"""SELECT 'lineitem' AS table_name, column_name, total_rows, violations,
          {r(pct("violations", "total_rows"), 2)} AS violation_pct,
          CASE WHEN {pct("violations", "total_rows")} <= 5 THEN 'PASS' ELSE 'FAIL' END AS status
        FROM (
          SELECT 'l_quantity' AS column_name, count(*) AS total_rows,
            count(*) FILTER (l_quantity < 1 OR l_quantity > 48) AS violations FROM lineitem
          UNION ALL
          SELECT 'l_discount', count(*), count(*) FILTER (l_discount < 0 OR l_discount > 0.08)
          FROM lineitem)""",
)
def export_check_csv(spark, sf_dir):
    lineitem = table(spark, sf_dir, "lineitem")
    checked = table_checks.range_checks(
        lineitem, "lineitem", {"l_quantity": Range(1, 48), "l_discount": Range(0, 0.08)}
    )
    report = rounded(checked, 2, "violation_pct").select(
        "table_name", "column_name", "total_rows", "violations", "violation_pct", "status"
    )
    path = work_dir(spark, "range-checks-csv")
    write_csv(report, path)
    return read_csv(spark, path, report.schema)


@query(
    "business_columns",
    "SELECT o_orderstatus, count(*) AS orders, "
    f"{r('sum(CAST(o_totalprice AS DECIMAL(18,2)))', 2)} AS sum_price, 6 AS columns_kept "
    "FROM orders GROUP BY ALL",
)
def kept_columns(spark, sf_dir):
    daily = stamp_metadata(table(spark, sf_dir, "orders"), "orders", "2024-01-31", as_of=AS_OF)
    business = business_columns(daily)
    return business.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("orders"),
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("sum_price"),
        F.lit(len(business.columns)).alias("columns_kept"),
    )


_TYPES = (
    "CASE data_type WHEN 'INTEGER' THEN 'int' WHEN 'BIGINT' THEN 'bigint' WHEN 'DOUBLE' THEN 'double' "
    "WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' "
    "WHEN 'FLOAT[]' THEN 'array<float>' ELSE data_type END"
)


@query(
    "schema_report",
    f"""SELECT c.table_name, c.column_name, {_TYPES} AS data_type, true AS nullable, v.total_rows
        FROM information_schema.columns c JOIN (
          {" UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS total_rows FROM {t}" for t in TABLES)}
        ) v ON c.table_name = v.table_name""",
)
def schema_report(spark, sf_dir):
    parts = []
    for name in TABLES:
        df = source(spark, sf_dir, name)
        fields = F.array(
            *[
                F.struct(
                    F.lit(s.name).alias("column_name"),
                    F.lit(s.type_name).alias("data_type"),
                    F.lit(s.nullable).alias("nullable"),
                )
                for s in column_specs(df)
            ]
        )
        counted = df.agg(F.count(F.lit(1)).alias("total_rows"))
        parts.append(counted.select(F.lit(name).alias("table_name"), F.inline(fields), "total_rows"))
    return union_all(parts)


