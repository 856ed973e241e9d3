"""Checks across rows and tables: keys, references, date order and sequences."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions.scalars import percent
from plumbline.functions.text import name as quoted
from plumbline.functions.text import digest
from plumbline.operators.checks import FAIL, PASS
from plumbline.operators.skew import salted_join


def key_of(cell: str, data_type: T.DataType) -> str:
    return digest(cell) if isinstance(data_type, T.StringType) else cell


def primary_key_check(df: DataFrame, table: str, key: list[str]) -> DataFrame:
    """Keys that occur more than once, and the rows they hold. Long texts are grouped by digest."""
    cells = [F.expr(key_of(quoted(k), df.schema[k].dataType)) for k in key]
    parts = [cell.alias(f"key_{i}") for i, cell in enumerate(cells)]
    counts = df.groupBy(*parts).agg(F.count(F.lit(1)).alias("n"))
    found = counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
        F.count(F.lit(1)).alias("distinct_keys"),
        F.count_if(F.col("n") > 1).alias("duplicate_keys"),
        F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("duplicate_rows"),
    )
    return found.select(
        F.lit(table).alias("table_name"),
        F.lit(", ".join(key)).alias("key_columns"),
        F.lit("primary_key").alias("check_type"),
        "*",
        F.when(F.col("duplicate_keys") == 0, PASS).otherwise(FAIL).alias("status"),
    )


def reference_check(
    child: DataFrame,
    column: str,
    parent: DataFrame,
    key: str,
    table: str,
    parent_name: str,
    check_type: str = "foreign_key",
) -> DataFrame:
    """Non-null values of a column that the parent table does not hold.

    Both sides are reduced to their distinct keys before they meet, so a key that fills a large
    part of either table is one row in the join.
    """
    child_keys = (
        child.where(F.col(quoted(column)).isNotNull())
        .groupBy(F.col(quoted(column)).alias("key_value"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    parent_keys = parent.select(F.col(quoted(key)).alias("key_value")).distinct()
    matched = child_keys.join(parent_keys.withColumn("known", F.lit(True)), "key_value", "left")
    orphan = F.col("known").isNull()
    found = matched.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("checked_rows"),
        F.coalesce(F.sum(F.when(orphan, F.col("n"))), F.lit(0)).alias("orphan_rows"),
        F.count_if(orphan).alias("orphan_keys"),
    )
    return found.select(
        F.lit(table).alias("table_name"),
        F.lit(column).alias("column_name"),
        F.lit(parent_name).alias("parent_table"),
        F.lit(check_type).alias("check_type"),
        "*",
        percent(F.col("orphan_rows"), F.col("checked_rows")).alias("orphan_pct"),
        F.when(F.col("orphan_rows") == 0, PASS).otherwise(FAIL).alias("status"),
    )


def orphan_rows(child: DataFrame, column: str, parent: DataFrame, key: str) -> DataFrame:
    """Orphaned values with the number of rows that hold them."""
    child_keys = (
        child.where(F.col(quoted(column)).isNotNull())
        .groupBy(F.col(quoted(column)).alias("key_value"))
        .agg(F.count(F.lit(1)).alias("row_count"))
    )
    parent_keys = parent.select(F.col(quoted(key)).alias("key_value")).distinct()
    return child_keys.join(parent_keys, "key_value", "left_anti")


def date_order_check(
    child: DataFrame,
    parent: DataFrame,
    on: tuple[str, str],
    later: str,
    earlier: str,
    table: str,
    spread_by: Iterable[str] = (),
) -> DataFrame:
    """Child rows whose date lies before the date of their parent row, whose key is unique.

    The rows of a key that fills a large part of the child are salted by their date and by the
    columns in ``spread_by``: name some that differ within such a key.
    """
    spread = [F.col(quoted(c)).alias(f"spread_{i}") for i, c in enumerate(spread_by)]
    dates = child.select(
        F.col(quoted(on[0])).alias("key_value"), F.col(quoted(later)).alias("later"), *spread
    )
    starts = parent.select(
        F.col(quoted(on[1])).alias("key_value"), F.col(quoted(earlier)).alias("earlier")
    )
    joined = salted_join(dates, starts, ["key_value"], dates.columns[1:])
    found = joined.agg(
        F.count(F.lit(1)).alias("checked_rows"),
        F.count_if(F.col("later") < F.col("earlier")).alias("violations"),
    )
    return found.select(
        F.lit(table).alias("table_name"),
        F.lit(f"{later} >= {earlier}").alias("rule"),
        F.lit("date_order").alias("check_type"),
        "*",
        percent(F.col("violations"), F.col("checked_rows")).alias("violation_pct"),
        F.when(F.col("violations") == 0, PASS).otherwise(FAIL).alias("status"),
    )


def sequence_gaps(df: DataFrame, position: str, group: str | None = None) -> DataFrame:
    """Gaps in whole-number sequences, per group.

    A run of consecutive numbers starts at a number without a predecessor; a sequence has one gap
    less than it has such starts. Each number announces its successor, and number and announcement
    meet in one shuffle on (group, number), so a large group is spread over all tasks.
    """
    key = F.col(quoted(group)) if group else F.lit(None).cast("string")
    number = F.col(quoted(position)).cast("bigint")
    seen = F.struct(number.alias("number"), F.lit(1).alias("present"), F.lit(0).alias("announced"))
    successor = F.struct(
        (number + 1).alias("number"), F.lit(0).alias("present"), F.lit(1).alias("announced")
    )
    marks = (
        df.where(F.col(quoted(position)).isNotNull())
        .select(key.alias("group_key"), F.inline(F.array(seen, successor)))
        .groupBy("group_key", "number")
        .agg(F.max("present").alias("present"), F.max("announced").alias("announced"))
        .where(F.col("present") == 1)
    )
    return marks.groupBy("group_key").agg(
        F.min("number").alias("first_number"),
        F.max("number").alias("last_number"),
        F.count(F.lit(1)).alias("distinct_numbers"),
        (F.count_if(F.col("announced") == 0) - 1).alias("gaps"),
        (F.max("number") - F.min("number") + 1 - F.count(F.lit(1))).alias("missing_numbers"),
    )


def sequence_check(df: DataFrame, table: str, position: str, group: str | None = None) -> DataFrame:
    """Whether any sequence of the table has a gap."""
    found = sequence_gaps(df, position, group).agg(
        F.count(F.lit(1)).alias("sequences"),
        F.count_if(F.col("gaps") > 0).alias("broken_sequences"),
        F.coalesce(F.sum("gaps"), F.lit(0)).alias("gaps"),
        F.coalesce(F.sum("missing_numbers"), F.lit(0)).alias("missing_numbers"),
    )
    return found.select(
        F.lit(table).alias("table_name"),
        F.lit(position).alias("column_name"),
        F.lit("sequence").alias("check_type"),
        "*",
        F.when(F.col("gaps") == 0, PASS).otherwise(FAIL).alias("status"),
    )
