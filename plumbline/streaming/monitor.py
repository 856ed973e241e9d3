"""Checks on newly arrived data: each micro-batch adds figures per day, and days are judged from them.

The figures of a batch can be added up (counts, sums, least and greatest values), so a day gives
the same result however its rows were spread over batches. A batch writes into its own folder and
overwrites it: a batch repeated after a failure counts once.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamReader

from plumbline.functions.scalars import percent
from plumbline.functions.text import name as quoted
from plumbline.plans.policy import RANGE_TOLERANCE_PCT, Range


def arrivals(reader: DataStreamReader, path: str) -> DataFrame:
    """A stream of the Parquet files at a path, be it a folder or a single file."""
    folder, _, name = path.rstrip("/").rpartition("/")
    # A file alone is no folder to watch; as a pattern the same path takes both.
    return reader.parquet(f"{folder}/[{name[0]}]{name[1:]}")


def daily_figures(df: DataFrame, timestamp: str, value: str, allowed: Range) -> DataFrame:
    """Figures per day of a batch of rows."""
    cell = F.col(quoted(value))
    return df.groupBy(F.to_date(F.col(quoted(timestamp))).alias("day")).agg(
        F.count(F.lit(1)).alias("record_count"),
        F.count_if(cell.isNull()).alias("null_count"),
        F.count_if((cell < allowed.low) | (cell > allowed.high)).alias("violations"),
        F.min(cell.cast("double")).alias("min_value"),
        F.max(cell.cast("double")).alias("max_value"),
    )


def judge_days(
    figures: DataFrame, volume: Range, tolerance_pct: float = RANGE_TOLERANCE_PCT
) -> DataFrame:
    """Add up the figures of all batches and judge each day."""
    days = figures.groupBy("day").agg(
        F.sum("record_count").alias("record_count"),
        F.sum("null_count").alias("null_count"),
        F.sum("violations").alias("violations"),
        F.min("min_value").alias("min_value"),
        F.max("max_value").alias("max_value"),
    )
    rows = F.col("record_count")

    def judged(good: Column) -> Column:
        return F.when(good, "PASS").otherwise("FAIL")

    return days.withColumns(
        {
            "volume_status": judged(rows.between(volume.low, volume.high)),
            "null_status": judged(F.col("null_count") == 0),
            "range_status": judged(percent(F.col("violations"), rows) <= tolerance_pct),
        }
    )


def monitor_arrivals(
    stream: DataFrame, out: str, checkpoint: str, timestamp: str, value: str, allowed: Range
) -> DataFrame:
    """Take in all that has arrived since the last call and return the figures so far."""

    def store(batch: DataFrame, batch_id: int) -> None:
        figures = daily_figures(batch, timestamp, value, allowed)
        # One row per day of the batch.
        figures.repartition(1).write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    query = (
        stream.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    spark = stream.sparkSession
    schema = (
        "day date, record_count bigint, null_count bigint, violations bigint, "
        "min_value double, max_value double, batch int"
    )
    try:
        return spark.read.schema(schema).parquet(out)
    except AnalysisException:  # nothing has arrived yet
        return spark.createDataFrame([], schema)
