"""From single results to the status of checks, tables and runs, and alerts on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions.scalars import percent
from plumbline.operators.checks import ERROR, FAIL, PASS, SKIP
from plumbline.plans.policy import (
    CHANGE_LIMIT,
    CHANGE_SLACK,
    CONSECUTIVE_FAILURES,
    FAILED_CHECKS_PCT,
    RETENTION_DAYS,
    VOLUME_DEVIATIONS,
    VOLUME_LEAST_RUNS,
)

FAIL_FIRST = (FAIL, ERROR)
ERROR_FIRST = (ERROR, FAIL)


def _keys(results: DataFrame, *names: str) -> list[str]:
    return [*(["run_id"] if "run_id" in results.columns else []), *names]


def _worst(status: Column, precedence: tuple[str, ...], otherwise: Column) -> Column:
    result = otherwise
    for value in reversed(precedence):
        result = F.when(F.bool_or(status == value), value).otherwise(result)
    return result


def rollup_checks(results: DataFrame) -> DataFrame:
    """Status per table and check: PASS if every column passes, SKIP if nothing was judged."""
    status = F.col("status")
    skipped = F.when(F.every(status == SKIP), SKIP).otherwise(PASS)
    return results.groupBy(*_keys(results, "table_name", "check_type")).agg(
        F.count(F.lit(1)).alias("results"),
        F.count_if(status == FAIL).alias("failed"),
        _worst(status, FAIL_FIRST, skipped).alias("status"),
    )


def rollup_tables(checks: DataFrame, precedence: tuple[str, ...] = FAIL_FIRST) -> DataFrame:
    """Status per table; a skipped check does not count against it."""
    return checks.groupBy(*_keys(checks, "table_name")).agg(
        F.count(F.lit(1)).alias("checks"),
        _worst(F.col("status"), precedence, F.lit(PASS)).alias("overall_status"),
    )


def rollup_run(tables: DataFrame) -> DataFrame:
    """Tables per status, in total or per run."""
    status = F.col("overall_status")
    keys = _keys(tables)
    grouped = tables.groupBy(*keys) if keys else tables
    return grouped.agg(
        F.count(F.lit(1)).alias("total_tables"),
        F.count_if(status == PASS).alias("successful_checks"),
        F.count_if(status == FAIL).alias("failed_checks"),
        F.count_if(status == ERROR).alias("error_checks"),
    )


def failed_share_alert(results: DataFrame, limit_pct: float = FAILED_CHECKS_PCT) -> DataFrame:
    """Runs whose share of failed checks exceeds the limit."""
    failed, total = F.count_if(F.col("status") == FAIL), F.count(F.lit(1))
    return (
        results.groupBy("run_id")
        .agg(total.alias("checks"), failed.alias("failed"))
        .withColumn("failed_pct", percent(F.col("failed"), F.col("checks")))
        .withColumn("alert", F.col("failed_pct") > limit_pct)
    )


def consecutive_failures(results: DataFrame, limit: int = CONSECUTIVE_FAILURES) -> DataFrame:
    """Series of at least ``limit`` failures of the same check in successive runs.

    The windows hold one row per run of one check.
    """
    keys = ["table_name", "check_type"]
    history = Window.partitionBy(*keys).orderBy("run_id")
    failures = Window.partitionBy(*keys, "status").orderBy("run_id")
    # Successive rows of one status share the difference of the two numberings.
    marked = results.withColumn(
        "series", F.row_number().over(history) - F.row_number().over(failures)
    ).where(F.col("status") == FAIL)
    return (
        marked.groupBy(*keys, "series")
        .agg(
            F.min("run_id").alias("first_run"),
            F.max("run_id").alias("last_run"),
            F.count(F.lit(1)).alias("failures"),
        )
        .where(F.col("failures") >= limit)
        .drop("series")
    )


def score_trend(scores: DataFrame, window_runs: int = 7) -> DataFrame:
    """Score of each table per run, its change since the previous run and its moving mean."""
    history = Window.partitionBy("table_name").orderBy("run_id")
    recent = history.rowsBetween(-(window_runs - 1), 0)
    per_run = scores.groupBy("table_name", "run_id").agg(
        F.avg("data_quality_score").alias("mean_score")
    )
    return per_run.withColumns(
        {
            "score_change": F.col("mean_score") - F.lag("mean_score").over(history),
            "moving_score": F.avg("mean_score").over(recent),
        }
    )


def change_points(scores: DataFrame, slack: float = CHANGE_SLACK, limit: float = CHANGE_LIMIT) -> DataFrame:
    """Where the score of a table has shifted: ``(table_name, run_id, mean_score, shift_up, shift_down, changed)``.

    Two sums per table (CUSUM) gather by how much each run lies above, and below, the mean of the runs since
    the last change, less ``slack``; neither falls below zero. A run that takes one of them over ``limit`` is a
    change, and mean and sums start again with it. ``scores`` has one row per table and run; what one task folds
    is the runs of a table.
    """
    ordered = F.array_sort(F.collect_list(F.struct("run_id", "mean_score")))
    off = "if(s.n = 0, 0D, x.mean_score - s.mean)"
    up, down = f"greatest(0D, s.up + {off} - {slack}D)", f"greatest(0D, s.down - {off} - {slack}D)"
    over = f"({up} > {limit}D OR {down} > {limit}D)"
    told = f"named_struct('run_id', x.run_id, 'mean_score', x.mean_score, 'shift_up', {up}, 'shift_down', {down}, 'changed', {over})"
    kind = "array<struct<run_id:string,mean_score:double,shift_up:double,shift_down:double,changed:boolean>>"
    step = f"""named_struct(
        'n', if({over}, 1L, s.n + 1), 'mean', if({over}, x.mean_score, s.mean + (x.mean_score - s.mean) / (s.n + 1)),
        'up', if({over}, 0D, {up}), 'down', if({over}, 0D, {down}), 'told', concat(s.told, array({told})))"""
    start = f"named_struct('n', 0L, 'mean', 0D, 'up', 0D, 'down', 0D, 'told', CAST(array() AS {kind}))"
    known = scores.where("mean_score IS NOT NULL").select("table_name", F.col("run_id").cast("string").alias("run_id"), F.col("mean_score").cast("double").alias("mean_score"))
    return (
        known.groupBy("table_name")
        .agg(ordered.alias("runs"))
        .selectExpr("table_name", f"inline(aggregate(runs, {start}, (s, x) -> {step}).told)")
    )


def expected_volumes(
    counts: DataFrame, deviations: float = VOLUME_DEVIATIONS, least_runs: int = VOLUME_LEAST_RUNS
) -> DataFrame:
    """Rows of each run against the same weekday of earlier runs: ``(table_name, run_id, record_count,
    earlier_runs, expected_count, spread, status)``.

    ``counts`` is ``(table_name, run_id, run_date, record_count)``, one row per table and run. Expected is the
    median, and the spread 1.4826 times the median distance from it, or one row if that is more. A count further away
    than so many spreads FAILs; with fewer than ``least_runs`` earlier runs of the weekday there is no
    expectation, and the run is a SKIP.
    """
    day = F.col("run_date").cast("date")
    weekday = Window.partitionBy("table_name", F.dayofweek(day)).orderBy(day, "run_id")
    before = F.collect_list("record_count").over(weekday.rowsBetween(Window.unboundedPreceding, -1))
    listed = counts.withColumn("before", before).selectExpr(
        "*", "size(before) AS earlier_runs", f"{_median('before')} AS middle"
    )
    spread = f"greatest(1D, 1.4826D * {_median('transform(before, x -> abs(x - middle))')})"
    far = F.abs(F.col("record_count") - F.col("expected_count")) > deviations * F.col("spread")
    enough = F.col("earlier_runs") >= least_runs
    return (
        listed.withColumn("expected_count", F.when(enough, F.col("middle")))
        .withColumn("spread", F.when(enough, F.expr(spread)))
        .select(
            "table_name",
            "run_id",
            "record_count",
            "earlier_runs",
            "expected_count",
            "spread",
            F.when(~enough, SKIP).when(far, FAIL).otherwise(PASS).alias("status"),
        )
    )


def _median(values: str) -> str:
    """SQL for the median of a list of numbers; null for an empty one."""
    at = f"element_at(sort_array({values}), CAST((size({values}) + {{0}}) div 2 AS INT))"
    return f"if(size({values}) > 0, ({at.format(1)} + {at.format(2)}) / 2D, CAST(NULL AS DOUBLE))"


def retained(results: DataFrame, run_date: str, as_of: str, days: int = RETENTION_DAYS) -> DataFrame:
    """Results of the last ``days`` days. On a table partitioned by the date this prunes folders."""
    cutoff = F.date_sub(F.lit(as_of).cast("date"), days)
    return results.where(F.col(run_date).cast("date") >= cutoff)
