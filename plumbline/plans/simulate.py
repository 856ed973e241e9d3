"""Snapshot runs: sample the sources of a day, vary them, stamp them and store them by day."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.functions.frames import union_all
from plumbline.functions.jobs import FAILURES, error_name
from plumbline.operators import snapshot
from plumbline.sources import load_source, overwrite_partitions


def write_snapshots(
    spark: SparkSession,
    refs: Mapping[str, str],
    keys: Mapping[str, str | list[str]],
    run_date: str,
    out: str,
    rates: Mapping[str, float] | None = None,
    widths: Mapping[str, Mapping[str, float]] | None = None,
    as_of: str | None = None,
    days: int | None = None,
) -> DataFrame:
    """Store a snapshot of each source below ``out`` and return one result row per table.

    ``days`` stores the days before ``run_date`` instead, all in one job per table. A day that is
    stored again replaces what was there. ``rates`` and ``widths`` give the sample rate and the
    jitter widths by table; the usual rate follows from the date. A source that fails becomes an
    ``error`` row and the others go on.
    """
    results = []
    for name, ref in refs.items():
        target = f"{name}_daily"
        try:
            rate = (rates or {}).get(name, snapshot.run_fraction(run_date))
            varied = snapshot.jitter(
                load_source(spark, ref), (widths or {}).get(name, {}), keys[name], run_date
            )
            if days is None:
                sampled = snapshot.hash_sample(varied, keys[name], run_date, rate)
                daily = snapshot.stamp_metadata(sampled, name, run_date, as_of=as_of)
                stored = overwrite_partitions(daily, f"{out.rstrip('/')}/{target}")
                stored = stored.where(F.col("ingestion_date") == F.lit(run_date))
            else:
                daily = snapshot.backfill(varied, name, keys[name], run_date, days, rate)
                stored = overwrite_partitions(daily, f"{out.rstrip('/')}/{target}")
                first = F.date_sub(F.lit(run_date).cast("date"), days)
                day = F.col("ingestion_date").cast("date")
                stored = stored.where((day >= first) & (day < F.lit(run_date).cast("date")))
            counted, status, message = stored.agg(F.expr("count(1) AS record_count")), "success", None
        except FAILURES as error:
            counted = spark.range(1).selectExpr("CAST(NULL AS BIGINT) AS record_count")
            status, message = "error", error_name(error)
        results.append(
            counted.select(
                F.lit(target).alias("table_name"),
                F.lit(status).alias("status"),
                "record_count",
                F.lit(message).cast("string").alias("message"),
            )
        )
    return union_all(results)
