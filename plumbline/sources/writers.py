"""Sinks: snapshot tables, exports and report files."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.functions.frames import union_all
from plumbline.functions.jobs import FAILURES, error_name
from plumbline.sources.readers import load_table


def ensure_namespace(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")


def append_table(
    df: DataFrame, name: str, path: str | None = None, partition: str = "ingestion_date"
) -> DataFrame:
    """Create the table, or append to it, partitioned by day."""
    # Days differ in size: rebalancing splits a large day over files and merges small ones.
    writer = df.hint("rebalance", partition).write.mode("append").format("parquet")
    if path and not df.sparkSession.catalog.tableExists(name):
        writer = writer.option("path", path)
    writer.partitionBy(partition).saveAsTable(name)
    return df.sparkSession.table(name)


def overwrite_partitions(df: DataFrame, path: str, partition: str = "ingestion_date") -> DataFrame:
    """Replace only the days present in ``df``; running a day twice leaves one copy of it."""
    (
        df.hint("rebalance", partition)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition)
        .parquet(path)
    )
    # With its schema, since a day without rows leaves no file to take it from.
    return df.sparkSession.read.schema(df.schema).parquet(path)


def export_tables(spark: SparkSession, sources: Mapping[str, str], target: str) -> DataFrame:
    """Copy tables to Parquet. A table that fails becomes an ERROR row and the rest go on."""
    parts = []
    for name, ref in sources.items():
        out = f"{target.rstrip('/')}/{name}"
        try:
            load_table(spark, ref).write.mode("overwrite").parquet(out)
            copied = spark.read.parquet(out).agg(F.count(F.lit(1)).alias("record_count"))
            status, message = "EXPORTED", ""
        except FAILURES as error:
            copied = spark.range(1).select(F.lit(0).cast("long").alias("record_count"))
            status, message = "ERROR", error_name(error)
        parts.append(
            copied.select(
                F.lit(name).alias("table_name"),
                "record_count",
                F.lit(status).alias("status"),
                F.lit(message).alias("message"),
            )
        )
    return union_all(parts)


def write_csv(df: DataFrame, path: str) -> None:
    """A report of a few rows per column, as one CSV file with a header."""
    df.repartition(1).write.mode("overwrite").option("header", True).csv(path)


def write_documents(df: DataFrame, path: str) -> None:
    """Nested rows as JSON lines."""
    df.write.mode("overwrite").json(path)


def write_lines(df: DataFrame, path: str) -> None:
    """Lines of a summary, in the order of ``line_no``, as one text file."""
    ordered = df.repartition(1).sortWithinPartitions("line_no")
    ordered.select("line").write.mode("overwrite").text(path)
