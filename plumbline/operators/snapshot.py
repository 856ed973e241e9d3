"""Daily snapshots: reproducible samples of the source tables with ingest metadata."""

from __future__ import annotations

import zlib
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.scalars import half_up, hash_unit, in_hash_sample, percent
from plumbline.functions.text import name as quoted

# Share of each loan table in a daily snapshot.
LOAN_SAMPLE_RATES = {
    "application_train": 0.01,
    "application_test": 0.02,
    "bureau": 0.005,
    "bureau_balance": 0.001,
    "credit_card_balance": 0.002,
    "installments_payments": 0.003,
    "POS_CASH_balance": 0.002,
    "previous_application": 0.01,
}

# Width of the jitter of each column.
JITTER_WIDTHS = {
    "application": {"AMT_INCOME_TOTAL": 0.10, "AMT_CREDIT": 0.06},
    "bureau": {"AMT_CREDIT_SUM": 0.08},
    "credit_card": {"AMT_BALANCE": 0.15},
    "installments": {"AMT_PAYMENT": 0.12, "AMT_INSTALMENT": 0.08},
    "pos_cash": {"CNT_INSTALMENT": 0.05},
}

# A run takes 1 % of the rows and between 0.5 % and 1.5 % more.
BASE_FRACTION, LEAST_EXTRA, MOST_EXTRA = 0.01, 0.005, 0.015


def run_seed(run_date: str) -> int:
    """The same seed for the same date, in any process."""
    return zlib.crc32(run_date.encode()) % 2147483647


def run_fraction(run_date: str, low: float | None = None, high: float | None = None) -> float:
    """Sample fraction of a day: from the date alone, inside the given or the usual limits."""
    low = BASE_FRACTION + LEAST_EXTRA if low is None else low
    high = BASE_FRACTION + MOST_EXTRA if high is None else high
    return low + (high - low) * run_seed(run_date) / 2147483647


def bernoulli_sample(df: DataFrame, fraction: float, seed: int) -> DataFrame:
    """Spark's own row sample; which rows it takes depends on the partitioning."""
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def _key(key: str | list[str]) -> list[Column]:
    """The key columns; a null is written out, so that rows without part of the key are not alike."""
    names = [key] if isinstance(key, str) else key
    return [F.coalesce(F.col(quoted(n)).cast("string"), F.lit("null")) for n in names]


def hash_sample(df: DataFrame, key: str | list[str], run_date: str, fraction: float) -> DataFrame:
    """Rows whose key and date hash below the fraction: the same rows on every run of that day.

    Rows with the same key are taken or left together, so the key should identify a row: a key that
    fills a third of the table would be in the sample as a whole or not at all.
    """
    return df.where(in_hash_sample(fraction, *_key(key), F.lit(run_date)))


def sample_counts(
    df: DataFrame, table: str, key: str | list[str], run_date: str, fraction: float
) -> DataFrame:
    """Original and sampled rows of a table, counted in one scan."""
    taken = in_hash_sample(fraction, *_key(key), F.lit(run_date))
    return df.agg(
        F.count(F.lit(1)).alias("original_count"), F.count_if(taken).alias("sampled_count")
    ).select(
        F.lit(table).alias("table_name"),
        F.lit(fraction).alias("sample_rate"),
        "original_count",
        "sampled_count",
        percent(F.col("sampled_count"), F.col("original_count")).alias("sampled_pct"),
    )


def stamp_metadata(
    df: DataFrame,
    table: str,
    run_date: str | Column,
    *,
    as_of: str | None = None,
    source: str = "daily_simulation",
    simulation_id: str | None = None,
) -> DataFrame:
    """Add the ingest columns. ``as_of`` fixes the time stamp; without it the clock is read.

    The batch is labelled by table and date; ``simulation_id`` labels the run, and without it the
    rows are numbered instead.
    """
    day = F.lit(run_date) if isinstance(run_date, str) else run_date
    moment = F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")
    run = F.monotonically_increasing_id() if simulation_id is None else F.lit(simulation_id)
    return df.withColumns(
        {
            "ingestion_date": day.cast("string"),
            "ingestion_timestamp": moment,
            "simulation_id": run,
            "data_source": F.lit(source),
            "batch_id": F.concat(F.lit(f"{table}_batch_"), day.cast("string")),
        }
    )


def stamp_run(
    df: DataFrame,
    run_date: str,
    simulation_id: str,
    as_of: str | None = None,
    source: str = "hdfs_csv_fresh",
) -> DataFrame:
    """The six ingest columns of a live run: rows are numbered and the seed is recorded."""
    moment = F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")
    return df.withColumns(
        {
            "ingestion_date": F.lit(run_date),
            "ingestion_timestamp": moment,
            "simulation_id": F.lit(simulation_id),
            "data_source": F.lit(source),
            "batch_id": F.monotonically_increasing_id(),
            "random_seed": F.lit(run_seed(run_date)),
        }
    )


def jitter(
    df: DataFrame,
    widths: Mapping[str, float],
    key: str | list[str] | None = None,
    seed: int | str = 0,
) -> DataFrame:
    """Multiply columns by a factor within ± width / 2 around 1; absent columns are passed over.

    With a key the factor follows from key and seed, so that a repeated task gives the same value.
    """
    changed = {}
    for column, width in widths.items():
        if column in df.columns:
            if key is None:
                unit = F.rand(seed if isinstance(seed, int) else run_seed(seed))
            else:
                unit = hash_unit(*_key(key), F.lit(column), F.lit(str(seed)))
            changed[column] = F.col(quoted(column)) * (1 + (unit - 0.5) * width)
    return df.withColumns(changed) if changed else df


def backfill(
    df: DataFrame,
    table: str,
    key: str | list[str],
    as_of: str,
    days: int = 7,
    fraction: float = 0.01,
) -> DataFrame:
    """Snapshots of the ``days`` days before ``as_of``, in one job.

    Each row is given the days whose sample it belongs to; rows of no sample leave right there.
    """
    last = F.date_sub(F.lit(as_of).cast("date"), 1)
    first = F.date_sub(F.lit(as_of).cast("date"), days)
    chosen = F.filter(
        F.transform(F.sequence(first, last), lambda d: d.cast("string")),
        lambda d: in_hash_sample(fraction, *_key(key), d),
    )
    exploded = df.withColumn("snapshot_date", F.explode(chosen))
    stamped = stamp_metadata(
        exploded, table, F.col("snapshot_date"), as_of=as_of, simulation_id=f"backfill_{as_of}"
    )
    return stamped.drop("snapshot_date")


def row_ids(df: DataFrame) -> DataFrame:
    """A number per row: unique, not consecutive, and without a shuffle."""
    return df.withColumn("row_id", F.monotonically_increasing_id())


def snapshot_summary(results: DataFrame) -> DataFrame:
    """Records, tables and success rate over the results of a snapshot run."""
    ok = F.col("status") == "success"
    return results.agg(
        F.coalesce(F.sum(F.when(ok, F.col("record_count"))), F.lit(0)).alias("total_records"),
        F.count_if(ok).alias("successful_tables"),
        F.count(F.lit(1)).alias("total_tables"),
    ).withColumn(
        "success_rate", half_up(percent(F.col("successful_tables"), F.col("total_tables")), 1)
    )
