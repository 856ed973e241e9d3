"""Snapshots: samples, ingest metadata, jitter and backfill."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.functions.frames import union_all
from plumbline.operators import snapshot
from plumbline.queries.registry import query, rounded, table
from plumbline.queries.sql import pct, r
from plumbline.sources import overwrite_partitions, work_dir

DAY = "2024-01-31"
AS_OF = "2024-01-31 00:00:00"
# The sample rates of the queries, by table, with the key that is hashed.
RATES = {
    "customer": ("c_custkey", 0.02),
    "orders": ("o_orderkey", 0.01),
    "lineitem": (["l_orderkey", "l_linenumber", "l_partkey"], 0.005),
    "part": ("p_partkey", 0.003),
    "events": ("event_id", 0.002),
}


def _prefix(key: str | list[str], day: str) -> str:
    names = [key] if isinstance(key, str) else key
    parts = " || '|' || ".join(f"CAST({name} AS VARCHAR)" for name in names)
    return f"substr(md5({parts} || '|' || {day}), 1, 8)"


def sampled(key: str | list[str], rate: float, day: str = f"'{DAY}'") -> str:
    return f"{_prefix(key, day)} < '{int(rate * 4294967296):08x}'"


@query("sample_bernoulli")
def sample_bernoulli(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return snapshot.bernoulli_sample(orders, 0.01, snapshot.run_seed(DAY))


@query(
    "sample_hash",
    f"SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE {sampled('o_orderkey', 0.01)}",
)
def sample_hash(spark, sf_dir):
    sampled = snapshot.hash_sample(table(spark, sf_dir, "orders"), "o_orderkey", DAY, 0.01)
    return sampled.select("o_orderkey", "o_custkey", "o_totalprice")


@query(
    "sample_rates",
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, CAST({rate} AS DOUBLE) AS sample_rate, count(*) AS sampled_count "
        f"FROM {t} WHERE {sampled(key, rate)}"
        for t, (key, rate) in RATES.items()
    ),
)
def sample_rates(spark, sf_dir):
    parts = []
    for name, (key, rate) in RATES.items():
        sampled = snapshot.hash_sample(table(spark, sf_dir, name), key, DAY, rate)
        parts.append(
            sampled.agg(F.count(F.lit(1)).alias("sampled_count")).select(
                F.lit(name).alias("table_name"), F.lit(rate).alias("sample_rate"), "sampled_count"
            )
        )
    return union_all(parts)


@query(
    "sample_ratio",
    f"SELECT *, {r(pct('sampled_count', 'original_count'), 2)} AS sampled_pct FROM ("
    + " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, CAST({rate} AS DOUBLE) AS sample_rate, "
        f"count(*) AS original_count, count(*) FILTER ({sampled(key, rate)}) AS sampled_count FROM {t}"
        for t, (key, rate) in RATES.items()
    )
    + ")",
)
def sample_ratio(spark, sf_dir):
    counted = [
        snapshot.sample_counts(table(spark, sf_dir, name), name, key, DAY, rate)
        for name, (key, rate) in RATES.items()
    ]
    return rounded(union_all(counted), 2, "sampled_pct")


@query(
    "stamp_metadata",
    f"""SELECT c_custkey, c_name, '{DAY}' AS ingestion_date,
          '{AS_OF}' AS ingestion_timestamp, 'run_1' AS simulation_id,
          'daily_simulation' AS data_source, 'customer_batch_{DAY}' AS batch_id
        FROM customer""",
)
def stamped(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    daily = snapshot.stamp_metadata(customers, "customer", DAY, as_of=AS_OF, simulation_id="run_1")
    return daily.withColumn("ingestion_timestamp", F.col("ingestion_timestamp").cast("string"))


@query(
    "stamp_run",
    f"""SELECT count(*) AS total_rows, count(*) AS distinct_batch_ids, '{DAY}' AS ingestion_date,
          '{AS_OF}' AS ingestion_timestamp, 'run_1' AS simulation_id, 'hdfs_csv_fresh' AS data_source,
          CAST({snapshot.run_seed(DAY)} AS BIGINT) AS random_seed
        FROM customer""",
)
def stamped_run(spark, sf_dir):
    """The six ingest columns of a live run; its numbered rows are counted, since numbers follow the files."""
    daily = snapshot.stamp_run(table(spark, sf_dir, "customer"), DAY, "run_1", AS_OF)
    found = daily.withColumn("ingestion_timestamp", F.col("ingestion_timestamp").cast("string"))
    return found.groupBy(
        "ingestion_date", "ingestion_timestamp", "simulation_id", "data_source", F.col("random_seed").cast("bigint").alias("random_seed")
    ).agg(F.count(F.lit(1)).alias("total_rows"), F.count_distinct("batch_id").alias("distinct_batch_ids"))


@query(
    "row_ids",
    "SELECT count(*) AS total_rows, count(*) AS distinct_ids, CAST(0 AS BIGINT) AS negative_ids FROM lineitem",
)
def numbered(spark, sf_dir):
    rows = snapshot.row_ids(table(spark, sf_dir, "lineitem").select("l_orderkey"))
    return rows.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_distinct("row_id").alias("distinct_ids"),
        F.count_if(F.col("row_id") < 0).alias("negative_ids"),
    )


_WIDTHS = {"c_acctbal": 0.10}


def _unit(key: str, column: str, seed: str) -> str:
    text = f"md5(CAST({key} AS VARCHAR) || '|{column}|{seed}')"
    return f"(CAST(CAST('0x' || substr({text}, 1, 8) AS UBIGINT) AS DOUBLE) / 4294967296.0)"


@query(
    "jitter_values",
    f"""SELECT c_custkey,
          {r(f"c_acctbal * (1 + ({_unit('c_custkey', 'c_acctbal', DAY)} - 0.5) * 0.10)", 4)} AS c_acctbal
        FROM customer""",
)
def jitter_values(spark, sf_dir):
    customers = table(spark, sf_dir, "customer")
    changed = snapshot.jitter(customers, _WIDTHS, key="c_custkey", seed=DAY)
    return rounded(changed, 4, "c_acctbal").select("c_custkey", "c_acctbal")


@query(
    "jitter_bounds",
    "SELECT count(*) AS total_rows, CAST(0 AS BIGINT) AS beyond_bounds FROM orders",
)
def jitter_bounds(spark, sf_dir):
    """Spark's random factor stays within half the width on either side."""
    orders = table(spark, sf_dir, "orders").withColumn("before", F.col("o_totalprice"))
    changed = snapshot.jitter(orders, {"o_totalprice": 0.06}, seed=snapshot.run_seed(DAY))
    share = F.abs(F.col("o_totalprice") / F.col("before") - 1)
    return changed.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(share > 0.03 + 1e-9).alias("beyond_bounds"),
    )


_DAYS = [f"2024-01-{day}" for day in range(24, 31)]


@query(
    "backfill_snapshots",
    " UNION ALL ".join(
        f"SELECT '{day}' AS ingestion_date, 'orders_batch_{day}' AS batch_id, count(*) AS record_count, "
        f"min(o_orderkey) AS first_key, max(o_orderkey) AS last_key "
        "FROM orders WHERE " + sampled("o_orderkey", 0.01, f"'{day}'")
        for day in _DAYS
    ),
)
def backfill(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    days = snapshot.backfill(orders, "orders", "o_orderkey", DAY, days=7, fraction=0.01)
    stored = overwrite_partitions(days, work_dir(spark, "orders-backfill"))
    day = F.col("ingestion_date").cast("date").cast("string").alias("ingestion_date")
    return stored.groupBy(day, "batch_id").agg(
        F.count(F.lit(1)).alias("record_count"),
        F.min("o_orderkey").alias("first_key"),
        F.max("o_orderkey").alias("last_key"),
    )


@query(
    "snapshot_summary",
    "SELECT CAST(sum(n) AS BIGINT) AS total_records, count(*) FILTER (n > 0) AS successful_tables, "
    f"count(*) AS total_tables, {r(pct('count(*) FILTER (n > 0)', 'count(*)'), 1)} AS success_rate FROM ("
    + " UNION ALL ".join(
        f"SELECT count(*) AS n FROM {t} WHERE {sampled(key, rate)}" for t, (key, rate) in RATES.items()
    )
    + ")",
)
def summary(spark, sf_dir):
    sampled = sample_rates(spark, sf_dir).withColumnRenamed("sampled_count", "record_count")
    status = F.when(F.col("record_count") > 0, "success").otherwise("error")
    return snapshot.snapshot_summary(sampled.withColumn("status", status))

