"""Pieces of the comparison SQL."""

from __future__ import annotations

from plumbline.queries.inputs import DERIVED, SCHEMAS


def r(expression: str, digits: int) -> str:
    """Round half up from the decimal value, as Spark does."""
    return f"CAST(round(CAST({expression} AS DECIMAL(38,9)), {digits}) AS DOUBLE)"


def pct(part: str, whole: str) -> str:
    return f"coalesce(CAST({part} AS DOUBLE) / nullif(CAST({whole} AS DOUBLE), 0) * 100, 0)"


def relation(name: str) -> str:
    return f"({DERIVED[name]}) AS {name}" if name in DERIVED else name


def profile(tables: list[str], by: str | None = None, distinct: bool = True) -> str:
    """One row per column, not rounded. ``by`` is an expression that splits the tables into runs."""
    parts = []
    for name in tables:
        for ordinal, (column, type_name, kind) in enumerate(SCHEMAS[name]):
            number = f"CAST({column} AS DOUBLE)" if kind == "n" else "CAST(NULL AS DOUBLE)"
            length = f"length({column})" if kind == "s" else "CAST(NULL AS INTEGER)"
            negative = f"count(*) FILTER ({column} < 0)" if kind == "n" else "CAST(NULL AS BIGINT)"
            blank = (
                f"count(*) FILTER ({column} IN ('', ' '))" if kind == "s" else "CAST(NULL AS BIGINT)"
            )
            values = (
                f"count(DISTINCT {column}) + coalesce(max(CASE WHEN {column} IS NULL THEN 1 ELSE 0 END), 0)"
                if distinct
                else "CAST(NULL AS BIGINT)"
            )
            parts.append(
                f"""
SELECT {f"{by} AS run_id," if by else ""} '{name}' AS table_name, '{column}' AS column_name,
  {ordinal} AS ordinal, '{type_name}' AS data_type, '{kind}' AS kind, count(*) AS total_rows,
  count(*) - count({column}) AS null_count, count({column}) AS non_null_count,
  CASE WHEN count({column}) > 0 THEN {values} END AS distinct_count,
  min({number}) + 0.0 AS min_num, max({number}) + 0.0 AS max_num, avg({number}) AS mean,
  stddev_samp({number}) AS stddev, {negative} AS negative_count,
  CAST(min({length}) AS INTEGER) AS min_len, CAST(max({length}) AS INTEGER) AS max_len,
  avg({length}) AS avg_len, {blank} AS blank_count
FROM {relation(name)} {"GROUP BY 1" if by else ""}"""
            )
    union = "\nUNION ALL\n".join(parts)
    return f"""
SELECT *, {pct("null_count", "total_rows")} AS null_pct, max_num - min_num AS range_span,
  CASE WHEN non_null_count > 0 THEN {pct("distinct_count", "total_rows")} END AS uniqueness_pct
FROM ({union})"""
