"""Values far from the mean: a first scan gives mean and spread, a second one compares with them."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions import text
from plumbline.functions.schema import NUMERIC, column_specs


def _numeric_columns(df: DataFrame, columns: Iterable[str] | None) -> list[str]:
    if columns is not None:
        return list(columns)
    return [s.name for s in column_specs(df) if s.kind == NUMERIC]


def _spread(df: DataFrame, names: list[str]) -> Column:
    """Mean and sample deviation of the columns, as one row that the second scan reads as a constant."""
    fields = ", ".join(
        f"'mean_{i}', avg(CAST({text.name(n)} AS DOUBLE)), 'sd_{i}', stddev(CAST({text.name(n)} AS DOUBLE))"
        for i, n in enumerate(names)
    )
    return df.agg(F.expr(f"named_struct({fields}) AS spread")).scalar()


# With more columns than this the two aggregates grow too large to be compiled well.
WIDEST_SPREAD = 100


def outlier_counts(
    df: DataFrame, table: str, k: float = 3.0, columns: Iterable[str] | None = None
) -> DataFrame:
    """Rows per numeric column beyond ``k`` sample deviations from the mean."""
    names = _numeric_columns(df, columns)
    if len(names) > WIDEST_SPREAD:
        return _grouped_outliers(df, table, k, names)
    spread = _spread(df, names)
    counts = ", ".join(
        f"'{i}', count_if(abs(CAST({text.name(n)} AS DOUBLE) - spread.mean_{i}) > {k!r}D * spread.sd_{i})"
        for i, n in enumerate(names)
    )
    counted = (
        df.select(*[F.expr(text.name(n)) for n in names], spread.alias("spread"))
        .agg(F.expr(f"named_struct({counts}) AS beyond"))
        .withColumn("spread", spread)
    )
    rows = [
        {
            "column_name": text.literal(n),
            "mean": f"spread.mean_{i}",
            "stddev": f"spread.sd_{i}",
            "outlier_count": f"beyond.`{i}`",
        }
        for i, n in enumerate(names)
    ]
    return counted.selectExpr(f"{text.literal(table)} AS table_name", f"inline({text.structs(rows)})")


def _grouped_outliers(df: DataFrame, table: str, k: float, names: list[str]) -> DataFrame:
    """The same for wide tables: cells become rows, and meet the one row of their column."""
    rows = [
        {"column_name": text.literal(n), "number": f"CAST({text.name(n)} AS DOUBLE)"} for n in names
    ]
    cells = df.selectExpr(f"inline({text.structs(rows)})")
    spread = cells.groupBy("column_name").agg(
        F.avg("number").alias("mean"), F.stddev("number").alias("stddev")
    )
    # A row per column of the table.
    counted = (
        cells.join(F.broadcast(spread), "column_name")
        .groupBy("column_name", "mean", "stddev")
        .agg(F.expr(f"count_if(abs(number - mean) > {k!r}D * stddev) AS outlier_count"))
    )
    # A table without rows has no cells: the list of columns keeps them in the result.
    listed = text.structs([{"column_name": text.literal(n)} for n in names])
    columns = df.sparkSession.range(1).selectExpr(f"inline({listed})")
    return (
        columns.join(counted, "column_name", "left")
        .na.fill(0, ["outlier_count"])
        .selectExpr(f"{text.literal(table)} AS table_name", "column_name", "mean", "stddev", "outlier_count")
    )


def zscore_rows(df: DataFrame, column: str, k: float = 3.0) -> DataFrame:
    """The rows whose value lies more than ``k`` deviations from the mean, with their z-score."""
    known = df.withColumn("spread", _spread(df, [column]))
    # No deviation at all: no row has a z-score.
    z_score = f"try_divide(CAST({text.name(column)} AS DOUBLE) - spread.mean_0, spread.sd_0)"
    scored = known.withColumn("z_score", F.expr(z_score)).drop("spread")
    return scored.where(F.abs(F.col("z_score")) > k)
