"""Time the headline queries: ``BENCH_SF_DIR`` names the data, ``BENCH_CPUS`` the local cores.

Prints one JSON line; each figure is the wall time of planning and running one query to the end.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from plumbline.queries import QUERIES

HEADLINE = [
    "table_volumes",
    "scan_parquet",
    "scan_csv_roundtrip",
    "sample_hash",
    "backfill_snapshots",
    "profile_nulls",
    "profile_numeric",
    "profile_stddev",
    "profile_distinct",
    "profile_by_run",
    "string_lengths",
    "outliers_3sigma",
    "zscore_rows",
    "value_frequencies",
    "top_values_5",
    "word_count",
    "check_null_bands",
    "check_id_uniqueness",
    "check_range_tolerant",
    "freshness",
    "score_model_a",
    "score_model_b",
    "score_model_c",
    "rollup_run",
    "drift_pair",
    "drift_consecutive",
    "rules_from_config",
    "check_foreign_key",
    "check_date_order",
    "check_sequence_gaps",
    "check_primary_key",
    "check_pattern",
    "report_detail",
    "run_document",
    "stream_daily_checks",
    "daily_run",
    "check_run",
    "snapshot_run",
    "drift_documents",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("plumbline-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = os.environ.get("BENCH_QUERIES", "").split() or HEADLINE
    times = {}
    # The first query of a session pays for starting it; that is no part of any figure.
    QUERIES["table_volumes"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    for name in names:
        started = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - started, 3)
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
