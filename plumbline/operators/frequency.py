"""Value frequencies, most frequent values and word counts."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions import text
from plumbline.functions.frames import union_all
from plumbline.functions.scalars import percent
from plumbline.functions.schema import STRING, column_specs

# Fixed value: how a null is shown among the frequent values.
NULL_TEXT = "None"


def value_frequencies(
    tables: Mapping[str, DataFrame],
    columns: Mapping[str, Iterable[str]] | None = None,
    share: bool = True,
) -> DataFrame:
    """Rows per value of each string column, null included, with the share of all rows.

    All columns of all tables are counted in one shuffle, and a frequent value is summed on the map
    side before it. ``columns`` names other columns to count. The shares need the row counts, which
    scans without columns give. Every text goes through the shuffle whole: where only the most frequent
    ones are wanted, use ``frequent_values``.
    """
    counts = _counts(_cells(tables, columns), "value")
    return _with_shares(counts, tables) if share else counts


def _cells(tables: Mapping[str, DataFrame], columns: Mapping[str, Iterable[str]] | None) -> DataFrame:
    """A row per cell of the counted columns."""
    parts = []
    for table, df in tables.items():
        names = (columns or {}).get(table) or [s.name for s in column_specs(df) if s.kind == STRING]
        rows = [
            {"column_name": text.literal(n), "value": f"CAST({text.name(n)} AS STRING)"} for n in names
        ]
        if rows:
            parts.append(
                df.selectExpr(f"{text.literal(table)} AS table_name", f"inline({text.structs(rows)})")
            )
    return union_all(parts)


def _counts(cells: DataFrame, value: str) -> DataFrame:
    return cells.groupBy("table_name", "column_name", value).agg(F.expr("count(1) AS value_count"))


def _with_shares(counts: DataFrame, tables: Mapping[str, DataFrame]) -> DataFrame:
    totals = [
        df.agg(F.expr("count(1) AS total_rows")).selectExpr(f"{text.literal(t)} AS table_name", "total_rows")
        for t, df in tables.items()
    ]
    # One row per table.
    known = counts.join(F.broadcast(union_all(totals)), "table_name")
    return known.withColumn(
        "value_pct", percent(F.col("value_count"), F.col("total_rows"))
    ).drop("total_rows")


def frequent_values(
    tables: Mapping[str, DataFrame],
    k: int,
    columns: Mapping[str, Iterable[str]] | None = None,
    share: bool = True,
) -> DataFrame:
    """The ``k`` most frequent values of each string column, with their position.

    Long texts are counted and ranked by digest. Those among the first ``k`` are looked up by a second
    scan, so no other long text goes through a shuffle. Equal counts are ordered by the value, a long
    one by its digest, null last.
    """
    cells = _cells(tables, columns)
    keyed = cells.withColumn("value_key", F.expr(text.digest("value")))
    best = top_values(_counts(keyed, "value_key"), k, "value_key")
    # At most k rows per column.
    wanted = best.where(F.length("value_key") > text.DIGEST_ABOVE).select(
        "table_name", "column_name", "value_key"
    )
    found = (
        keyed.where(F.length("value") > text.DIGEST_ABOVE)
        .join(F.broadcast(wanted), ["table_name", "column_name", "value_key"])
        .groupBy("table_name", "column_name", "value_key")
        .agg(F.any_value("value").alias("text"))
    )
    joined = best.join(found, ["table_name", "column_name", "value_key"], "left")
    shown = joined.withColumn("value", F.coalesce("text", "value_key")).drop("text", "value_key")
    return _with_shares(shown, tables) if share else shown


def top_values(frequencies: DataFrame, k: int, value: str = "value") -> DataFrame:
    """The ``k`` most frequent values per column; equal counts are ordered by value, null last.

    The rank is below a limit, so each task keeps ``k`` rows per column before the shuffle.
    """
    order = Window.partitionBy("table_name", "column_name").orderBy(
        F.desc("value_count"), F.asc_nulls_last(value)
    )
    return frequencies.withColumn("position", F.row_number().over(order)).where(F.col("position") <= k)


def shown_value(value: str = "value"):
    return F.coalesce(F.col(value), F.lit(NULL_TEXT))


def most_frequent(frequencies: DataFrame) -> DataFrame:
    """The first of the frequent values of each column."""
    return top_values(frequencies, 1).drop("position")


def word_count(df: DataFrame, column: str) -> DataFrame:
    """Occurrences of each word; words are separated by blanks, tabs and line ends."""
    words = F.explode(F.split(F.col(text.name(column)), r"[ \t\n\r\f]+"))
    return (
        df.select(words.alias("word"))
        .where(F.col("word") != "")
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("occurrences"))
    )
