"""Checks that read the table itself. Each call is one aggregate over one scan."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions.scalars import age_hours, half_up, percent
from plumbline.functions.schema import column_specs
from plumbline.functions.text import name as quoted
from plumbline.operators.checks import FAIL, PASS, SKIP
from plumbline.plans.policy import FRESHNESS_HOURS, RANGE_TOLERANCE_PCT, Range


def row_counts(df: DataFrame, table: str, by: str | None = None) -> DataFrame:
    keys = [F.col(quoted(by)).alias("run_id")] if by else []
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("record_count"))
        .select(*(["run_id"] if by else []), F.lit(table).alias("table_name"), "record_count")
    )


def _violations(
    df: DataFrame, table: str, check_type: str, rules: dict[str, tuple[Column, list[Column]]], by: str | None
) -> DataFrame:
    """Rows of the table that break each rule: all rules in one pass, one result row per rule."""
    groups = [F.col(quoted(by)).alias("run_id")] if by else []
    counted = [F.count_if(broken).alias(f"broken_{i}") for i, (broken, _) in enumerate(rules.values())]
    wide = df.groupBy(*groups).agg(F.count(F.lit(1)).alias("total_rows"), *counted)
    rows = F.array(
        *[
            F.struct(
                F.lit(column).alias("column_name"),
                F.col(f"broken_{i}").alias("violations"),
                *extra,
            )
            for i, (column, (_, extra)) in enumerate(rules.items())
        ]
    )
    keys = ["run_id"] if by else []
    return wide.select(
        *keys,
        F.lit(table).alias("table_name"),
        F.lit(check_type).alias("check_type"),
        "total_rows",
        F.inline(rows),
    ).withColumn("violation_pct", percent(F.col("violations"), F.col("total_rows")))


def range_checks(
    df: DataFrame,
    table: str,
    ranges: Mapping[str, Range],
    tolerance_pct: float = RANGE_TOLERANCE_PCT,
    by: str | None = None,
) -> DataFrame:
    """Values outside their inclusive bounds; nulls are no violations, NaN lies above every bound.

    Up to ``tolerance_pct`` of all rows may lie outside; 0 lets none through. Rules for columns
    that the table does not have are left out.
    """
    present = {c: r for c, r in ranges.items() if c in df.columns}
    if not present:
        return _no_rules(df, table, "range_checks", by)
    rules = {}
    for column, limit in present.items():
        cell = F.col(quoted(column))
        rules[column] = (
            (cell < limit.low) | (cell > limit.high),
            [
                F.lit(float(limit.low)).alias("min_allowed"),
                F.lit(float(limit.high)).alias("max_allowed"),
            ],
        )
    checked = _violations(df, table, "range_checks", rules, by)
    passed = F.when(F.col("violation_pct") <= tolerance_pct, PASS).otherwise(FAIL)
    return checked.withColumns({"status": passed, "message": F.lit(None).cast("string")})


def _no_rules(df: DataFrame, table: str, check_type: str, by: str | None) -> DataFrame:
    counts = row_counts(df, table, by)
    return counts.select(
        *(["run_id"] if by else []),
        "table_name",
        F.lit(check_type).alias("check_type"),
        F.col("record_count").alias("total_rows"),
        F.lit(None).cast("string").alias("column_name"),
        F.lit(0).cast("bigint").alias("violations"),
        F.lit(None).cast("double").alias("min_allowed"),
        F.lit(None).cast("double").alias("max_allowed"),
        F.lit(0.0).alias("violation_pct"),
        F.lit(PASS).alias("status"),
        F.lit("No range rules defined for this table").alias("message"),
    )


def pattern_checks(
    df: DataFrame,
    table: str,
    patterns: Mapping[str, str],
    tolerance_pct: float = 0.0,
    by: str | None = None,
) -> DataFrame:
    """Non-null values that do not match the regular expression of their column."""
    rules = {
        column: (~F.col(quoted(column)).rlike(pattern), [F.lit(pattern).alias("pattern")])
        for column, pattern in patterns.items()
    }
    checked = _violations(df, table, "pattern", rules, by)
    passed = F.col("violation_pct") <= tolerance_pct
    return checked.withColumn("status", F.when(passed, PASS).otherwise(FAIL))


def castable_checks(
    df: DataFrame, table: str, expected: Mapping[str, str], by: str | None = None
) -> DataFrame:
    """Non-null values that cannot be read as the expected type."""
    rules = {}
    for column, type_name in expected.items():
        cell = F.col(quoted(column))
        broken = cell.isNotNull() & cell.try_cast(type_name).isNull()
        rules[column] = (broken, [F.lit(type_name).alias("expected_type")])
    checked = _violations(df, table, "castable", rules, by)
    return checked.withColumn("status", F.when(F.col("violations") == 0, PASS).otherwise(FAIL))


def sign_counts(df: DataFrame, table: str, columns: Iterable[str]) -> DataFrame:
    """Negative values of amount and count columns."""
    rules = {c: (F.col(quoted(c)) < 0, []) for c in columns}
    return _violations(df, table, "negative_values", rules, None)


def blank_counts(df: DataFrame, table: str, columns: Iterable[str]) -> DataFrame:
    """Strings that are empty or a single space."""
    rules = {c: (F.col(quoted(c)).isin("", " "), []) for c in columns}
    return _violations(df, table, "blank_strings", rules, None)


def timestamp_column(df: DataFrame) -> str | None:
    """The first column of a timestamp type, whatever its name."""
    for spec in column_specs(df, skip=()):
        if isinstance(spec.data_type, (T.TimestampType, T.TimestampNTZType)):
            return spec.name
    return None


def freshness_check(
    df: DataFrame,
    table: str,
    as_of: str,
    limit_hours: float = FRESHNESS_HOURS,
    column: str | None = None,
    no_column: str = SKIP,
    no_value: str = SKIP,
) -> DataFrame:
    """Hours between the latest timestamp and ``as_of``.

    ``no_column`` and ``no_value`` give the status of a table without a timestamp column, and of
    one where the column is null throughout. A string column is read as ISO 8601.
    """
    column = column or timestamp_column(df)
    result = [
        F.lit(table).alias("table_name"),
        F.lit("freshness").alias("check_type"),
        F.lit(column).cast("string").alias("column_name"),
        F.lit(float(limit_hours)).alias("threshold_hours"),
    ]
    if column is None:
        counted = df.agg(F.count(F.lit(1)).alias("total_rows"))
        return counted.select(
            *result,
            "total_rows",
            F.lit(None).cast("double").alias("hours_old"),
            F.lit(no_column).alias("status"),
            F.lit("No timestamp column found").alias("message"),
        )
    cell = F.col(quoted(column))
    if isinstance(df.schema[column].dataType, T.StringType):
        cell = F.try_to_timestamp(cell)
    latest = df.agg(F.count(F.lit(1)).alias("total_rows"), F.max(cell).alias("latest"))
    aged = latest.withColumn("hours_old", age_hours(F.col("latest"), F.lit(as_of).cast("timestamp")))
    hours = F.col("hours_old")
    return aged.select(
        *result,
        "total_rows",
        "hours_old",
        F.when(hours.isNull(), no_value)
        .when(hours <= limit_hours, PASS)
        .otherwise(FAIL)
        .alias("status"),
        F.when(hours.isNull(), "No valid timestamps found")
        .otherwise(F.format_string("Data is %.1f hours old", half_up(hours, 1)))
        .alias("message"),
    )


def quarantine(df: DataFrame, critical: Iterable[str]) -> DataFrame:
    """The table with a column that tells accepted rows from those with a null in a critical column."""
    missing = F.array_compact(
        F.array(*[F.when(F.col(quoted(c)).isNull(), F.lit(c)) for c in critical])
    )
    return df.withColumn("null_columns", F.array_join(missing, ", ")).withColumn(
        "accepted", F.col("null_columns") == ""
    )


def split_quarantine(df: DataFrame, critical: Iterable[str]) -> tuple[DataFrame, DataFrame]:
    """Accepted and rejected rows, as two tables."""
    marked = quarantine(df, critical)
    accepted = marked.where("accepted").drop("null_columns", "accepted")
    return accepted, marked.where("not accepted").drop("accepted")
