"""Sketches of every column, kept with each run and merged over runs instead of reading the runs again.

A run leaves a row per column: rows, nulls, least and greatest value, an HLL sketch of its values and, of
numbers, a KLL sketch of their distribution. Both are of bounded size and can be merged, so a window of thirty
days is thirty small rows per column. Counts merge exactly. The distinct count has a relative standard error
of ``DISTINCT_ERROR``, a quantile lies within ``RANK_ERROR`` of its rank.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions import text
from plumbline.functions.schema import METADATA_COLUMNS, NUMERIC, column_specs

#: Registers of a distinct sketch are two to this power; the size of a quantile sketch.
HLL_BITS, KLL_SIZE = 12, 200
#: 1.04 over the root of the registers; the normalised rank error that the size of the sketch gives at 99 %.
DISTINCT_ERROR, RANK_ERROR = 1.04 / 2 ** (HLL_BITS / 2), 0.0165
FIELDS = ("column_name", "kind", "total_rows", "null_count", "min_num", "max_num", "distinct_sketch", "quantile_sketch")


def _sketched(cell: str, data_type: T.DataType) -> str:
    """Something that an HLL sketch takes, equal for equal values."""
    if isinstance(data_type, (T.StringType, T.BinaryType, T.IntegerType, T.LongType)):
        return cell
    if isinstance(data_type, (T.FloatType, T.DoubleType)):
        # Both zeros are one value.
        return f"CAST({cell} + 0D AS STRING)"
    return f"to_json(named_struct('v', {cell}))"


def column_sketches(df: DataFrame, table: str, by: str | None = None) -> DataFrame:
    """A row of sketches per business column, and per run that ``by`` names, from one scan."""
    specs = column_specs(df, skip=[*METADATA_COLUMNS, *([by] if by else [])])
    aggregates, rows = ["count(1) AS total_rows"], []
    for i, spec in enumerate(specs):
        cell, number = text.name(spec.name), spec.kind == NUMERIC
        double = f"CAST({cell} AS DOUBLE)"
        aggregates.append(f"count_if({cell} IS NULL) AS n{i}")
        aggregates.append(f"hll_sketch_agg({_sketched(cell, spec.data_type)}, {HLL_BITS}) AS d{i}" if spec.countable else f"CAST(NULL AS BINARY) AS d{i}")
        if number:
            # NaN has no rank.
            finite = f"CASE WHEN NOT isnan({double}) THEN {double} END"
            aggregates += [f"min({double}) AS l{i}", f"max({double}) AS g{i}", f"kll_sketch_agg_double({finite}, {KLL_SIZE}) AS q{i}"]
        rows.append(
            {
                "column_name": text.literal(spec.name),
                "kind": text.literal(spec.kind),
                "null_count": f"n{i}",
                "min_num": f"l{i}" if number else "CAST(NULL AS DOUBLE)",
                "max_num": f"g{i}" if number else "CAST(NULL AS DOUBLE)",
                "distinct_sketch": f"d{i}",
                "quantile_sketch": f"q{i}" if number else "CAST(NULL AS BINARY)",
            }
        )
    keys = [F.expr(f"{text.name(by)} AS run_id")] if by else []
    wide = df.groupBy(*keys).agg(*map(F.expr, aggregates))
    run = ["run_id"] if by else []
    return wide.selectExpr(
        *run, f"{text.literal(table)} AS table_name", "total_rows", f"inline({text.structs(rows)})"
    ).select(*run, "table_name", *FIELDS)


def merged(sketches: DataFrame, *keys: str) -> DataFrame:
    """The sketches of several runs, or tables, as one per column and value of ``keys``."""
    return sketches.groupBy(*keys, "column_name", "kind").agg(
        F.sum("total_rows").alias("total_rows"),
        F.sum("null_count").alias("null_count"),
        F.min("min_num").alias("min_num"),
        F.max("max_num").alias("max_num"),
        F.expr("CASE WHEN count(distinct_sketch) > 0 THEN hll_union_agg(distinct_sketch) END AS distinct_sketch"),
        F.expr("CASE WHEN count(quantile_sketch) > 0 THEN kll_merge_agg_double(quantile_sketch) END AS quantile_sketch"),
    )


def estimated(sketches: DataFrame, ranks: tuple[float, ...] = (0.25, 0.5, 0.75)) -> DataFrame:
    """What the sketches tell: ``distinct_count`` with null as one value, ``uniqueness_pct``, the values at
    ``ranks`` as ``quantiles``, and from quartiles the bounds beyond which a value is an outlier."""
    some = "total_rows > null_count"
    quantile = f"kll_sketch_get_quantile_double(quantile_sketch, array({', '.join(f'{x}D' for x in ranks)}))"
    quartiles = "kll_sketch_get_quantile_double(quantile_sketch, array(0.25D, 0.75D))"
    known = f"{some} AND kll_sketch_get_n_double(quantile_sketch) > 0"
    found = sketches.withColumns(
        {
            "distinct_count": F.expr(
                f"CASE WHEN {some} THEN hll_sketch_estimate(distinct_sketch) + CAST(null_count > 0 AS INT) END"
            ),
            "quantiles": F.expr(f"CASE WHEN {known} THEN {quantile} END"),
            "quartiles": F.expr(f"CASE WHEN {known} THEN {quartiles} END"),
        }
    )
    width = "1.5D * (quartiles[1] - quartiles[0])"
    return found.withColumns(
        {
            "uniqueness_pct": F.expr("CASE WHEN distinct_count IS NOT NULL THEN least(100D, distinct_count * 100D / total_rows) END"),
            "outliers_below": F.expr(f"quartiles[0] - {width}"),
            "outliers_above": F.expr(f"quartiles[1] + {width}"),
        }
    ).drop("distinct_sketch", "quantile_sketch", "quartiles")
