"""Scans: CSV, Parquet, catalog tables, views and stored run documents."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions.frames import union_all
from plumbline.functions.jobs import FAILURES, error_name, is_missing


def csv_schema(spark: SparkSession, path: str) -> T.StructType:
    """Types of a CSV with a header, inferred from every row. Infer once and keep the result."""
    return spark.read.csv(path, header=True, inferSchema=True).schema


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """CSV with a header. With a schema the scan is lazy; without one the types cost a full pass."""
    return spark.read.csv(path, header=True, schema=schema or csv_schema(spark, path))


def load_table(spark: SparkSession, ref: str, table_format: str | None = None) -> DataFrame:
    """A table by catalog name or by path.

    ``table_format`` names a table format to try first; a path that is no table of it, or a session
    without that format, falls back to Parquet.
    """
    if "/" not in ref and not ref.endswith((".parquet", ".csv")):
        return spark.read.table(ref)
    if table_format:
        try:
            return spark.read.format(table_format).load(ref)
        except (PySparkException, Py4JJavaError) as error:  # a missing format is raised by the JVM
            if not _is_other_format(error):
                raise
    return spark.read.parquet(ref)


def _is_other_format(error: Exception) -> bool:
    """Whether the session lacks the format, or the path is no table of it.

    Any other error stays one: the raw files of a versioned table hold deleted rows too.
    """
    condition = error.getCondition() or "" if isinstance(error, PySparkException) else ""
    known = condition == "DATA_SOURCE_NOT_FOUND" or condition.endswith("TABLE_NOT_FOUND")
    return known or "ClassNotFoundException" in str(error)


def load_source(spark: SparkSession, ref: str) -> DataFrame:
    """A source by path or catalog name; a path that ends in ``.csv`` is read as CSV."""
    return read_csv(spark, ref) if ref.endswith(".csv") else load_table(spark, ref)


def load_each(
    spark: SparkSession, refs: Mapping[str, str], load: Callable[[SparkSession, str], DataFrame] | None = None
) -> tuple[dict[str, DataFrame], dict[str, str]]:
    """The tables that can be loaded, and the error of each of the others."""
    tables, errors = {}, {}
    for name, ref in refs.items():
        try:
            tables[name] = (load or load_source)(spark, ref)
        except FAILURES as error:
            errors[name] = error_name(error)
    return tables, errors


def load_tables(
    spark: SparkSession, folder: str, names: Iterable[str], suffix: str = ".parquet"
) -> dict[str, DataFrame]:
    """Name to lazy table, for several tables of one folder."""
    return {name: load_table(spark, f"{folder.rstrip('/')}/{name}{suffix}") for name in names}


def read_view(df: DataFrame, name: str) -> DataFrame:
    """Register the table as a temporary view and read it back by name."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def table_inventory(spark: SparkSession, refs: Mapping[str, str]) -> DataFrame:
    """Which tables exist and how many rows they hold; a missing one is SKIPPED, one that cannot be
    read an ERROR. Each is counted by a job of its own, so that a broken one stops no other."""
    parts = []
    for name, ref in refs.items():
        try:
            rows, found = load_table(spark, ref).count(), True
            status, message = "FOUND", "Table found"
        except FAILURES as error:
            rows, found = 0, not is_missing(error)
            status, message = ("ERROR", error_name(error)) if found else ("SKIPPED", "Table not found")
        parts.append(
            spark.range(1).select(
                F.lit(name).alias("table_name"),
                F.lit(found).alias("table_exists"),
                F.lit(rows).cast("long").alias("record_count"),
                F.lit(status).alias("status"),
                F.lit(message).alias("message"),
            )
        )
    return union_all(parts)


def read_documents(spark: SparkSession, pattern: str, schema: T.StructType | str) -> DataFrame:
    """Stored run documents; the run id is that of the folder ``run_id=…``, else the time stamp in the
    file name."""
    path = F.input_file_name()
    return spark.read.schema(schema).json(pattern).withColumn(
        "run_id",
        F.coalesce(
            F.nullif(F.regexp_extract(path, r"/run_id=(\d{8}_\d{6})(?:/|$)", 1), F.lit("")),
            F.regexp_extract(path, r"(\d{8}_\d{6})[^/]*$", 1),
        ),
    )
