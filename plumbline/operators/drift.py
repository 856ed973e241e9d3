"""Comparison of profiles between runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

STAT_KEYS = ["table_name", "column_name", "stat"]
NO_DRIFT = "No drift detected or no comparable columns found."


def percent_change(old: Column, new: Column) -> Column:
    """Change in percent of the old value; from 0 it is infinite, and none from 0 to 0."""
    from_zero = F.when(new == 0, F.lit(None)).otherwise(F.lit(float("inf")))
    return F.when(old == 0, from_zero).otherwise(F.try_divide(new - old, old) * 100)


def drift_pair(old: DataFrame, new: DataFrame) -> DataFrame:
    """Every statistic that both profiles hold, with its change. Profiles are in long form."""
    return (
        old.select(*STAT_KEYS, F.col("value").alias("old_value"))
        .join(new.select(*STAT_KEYS, F.col("value").alias("new_value")), STAT_KEYS)
        .withColumn("percent_change", percent_change(F.col("old_value"), F.col("new_value")))
    )


def drift_between(long: DataFrame, old_run: str, new_run: str) -> DataFrame:
    """Drift between two runs of a stored profile, side by side in one grouping."""
    run = F.col("run_id")
    both = (
        long.where(run.isin(old_run, new_run))
        .groupBy(*STAT_KEYS)
        .agg(
            F.max(F.when(run == old_run, F.col("value"))).alias("old_value"),
            F.max(F.when(run == new_run, F.col("value"))).alias("new_value"),
        )
        .where("old_value IS NOT NULL AND new_value IS NOT NULL")
    )
    return both.select(
        F.lit(old_run).alias("old_run"),
        F.lit(new_run).alias("new_run"),
        "*",
        percent_change(F.col("old_value"), F.col("new_value")).alias("percent_change"),
    )


def run_pairs(runs: DataFrame) -> DataFrame:
    """Each run with its successor. One row per run: the window sees no table data."""
    order = Window.orderBy("run_id")
    return (
        runs.select(F.col("run_id"))
        .distinct()
        .select(F.col("run_id").alias("old_run"), F.lead("run_id").over(order).alias("new_run"))
        .where(F.col("new_run").isNotNull())
    )


def drift_consecutive(long: DataFrame, runs: DataFrame | None = None) -> DataFrame:
    """Drift from each run to the next run of the whole series.

    A statistic that the next run lacks has no partner there: the run after it does not stand in.
    """
    pairs = run_pairs(long if runs is None else runs)
    later = Window.partitionBy(*STAT_KEYS).orderBy("run_id")
    followed = long.withColumns(
        {"next_run": F.lead("run_id").over(later), "new_value": F.lead("value").over(later)}
    )
    # The next run of this statistic must be the next run of the series.
    matched = followed.join(
        pairs, (F.col("run_id") == F.col("old_run")) & (F.col("next_run") == F.col("new_run"))
    )
    return matched.select(
        "old_run",
        "new_run",
        *STAT_KEYS,
        F.col("value").alias("old_value"),
        "new_value",
        percent_change(F.col("value"), F.col("new_value")).alias("percent_change"),
    )


def drift_message(drift: DataFrame) -> DataFrame:
    """One row that counts the compared statistics and carries a message when there are none."""
    return drift.agg(F.count(F.lit(1)).alias("compared")).withColumn(
        "message", F.when(F.col("compared") == 0, NO_DRIFT)
    )


def change_sign(change: Column) -> Column:
    """Direction of a change as reports show it; nothing where there is no change value."""
    return F.when(change < 0, "neg").when(change >= 0, "pos")
