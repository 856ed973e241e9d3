"""Column profiles: one long row per column (and per run, if asked), from one scan per table.

Three plans give the same figures:

* Counted values (``distinct="exact"``): the cells of all columns of all tables become rows
  ``(column, value)`` and are counted per value, in one shuffle. The map side already collapses
  repeated values, so a value that fills a third of a table reaches the shuffle once per task, and
  rows stay a few fields wide however wide the table is. All statistics follow from the counts; the
  deviation reads them a second time, around the mean.
* Grouped cells (``distinct="approx"``, and wide tables): the cells become rows as above, but are
  grouped per column straight away, with buffers of fixed size. A task shuffles a row per column.
* One aggregate (other tables): a task shuffles one row. Fastest for a few dozen columns; beyond that
  the aggregate grows too large to be compiled well.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions import text
from plumbline.functions.frames import union_all
from plumbline.functions.schema import METADATA_COLUMNS, NUMERIC, STRING, ColumnSpec, column_specs

# An aggregate of more figures than this takes longer than grouping the cells.
WIDEST_AGGREGATE = 300

PROFILE_FIELDS = (
    "table_name",
    "column_name",
    "ordinal",
    "data_type",
    "kind",
    "total_rows",
    "null_count",
    "null_pct",
    "non_null_count",
    "distinct_count",
    "uniqueness_pct",
    "min_num",
    "max_num",
    "mean",
    "range_span",
    "stddev",
    "negative_count",
    "min_len",
    "max_len",
    "avg_len",
    "blank_count",
)

# Statistic groups of the aggregate plan.
RANGE, SIGNS, SPREAD, LENGTHS, BLANKS = "range", "signs", "spread", "lengths", "blanks"
ALL_STATS = (RANGE, SIGNS, SPREAD, LENGTHS, BLANKS)
# What scores and findings are made of.
WITHOUT_SPREAD = (RANGE, SIGNS, LENGTHS, BLANKS)
# What counts as a blank string.
BLANKS_SQL = "('', ' ')"


def column_profile(df: DataFrame, table: str, **options) -> DataFrame:
    """Profile every business column of a table; see ``profile_tables`` for the options."""
    return profile_tables({table: df}, **options)


def profile_tables(
    tables: Mapping[str, DataFrame],
    *,
    by: str | None = None,
    distinct: str = "exact",
    stats: Iterable[str] = ALL_STATS,
    max_columns: int | None = None,
    named: str = "",
    kinds: Iterable[str] = (),
    skip: Iterable[str] = METADATA_COLUMNS,
) -> DataFrame:
    """Profile every business column of several tables, as one plan.

    ``by`` names a column that splits the tables into runs: each run is profiled on its own, in the
    same job. ``stats`` limits the statistics of the aggregate plan, and leaves the deviation out of the
    exact one, which then reads its counts once only; ``max_columns`` keeps the first columns, ``named`` those whose name matches a regular expression, and ``kinds`` those of the given kinds, if any.
    Columns left out are not read.
    """
    hidden = [*skip, *([by] if by else [])]
    kept = frozenset(kinds)
    specs = {
        t: [
            s
            for s in column_specs(df, skip=hidden, max_columns=max_columns)
            if re.search(named, s.name) and (not kept or s.kind in kept)
        ]
        for t, df in tables.items()
    }
    if distinct == "exact":
        long = _from_value_counts(tables, specs, by, SPREAD in frozenset(stats))
    elif distinct == "approx":
        long = _from_grouped_cells(tables, specs, by, frozenset(stats), estimate=True)
    elif distinct == "none":
        long = _from_aggregates(tables, specs, by, frozenset(stats))
    else:
        raise ValueError(f"unknown distinct mode: {distinct}")
    derived = {
        "null_pct": text.percent("null_count", "total_rows"),
        "non_null_count": "total_rows - null_count",
        # A column without any value is not judged for uniqueness.
        "distinct_count": "CASE WHEN total_rows > null_count THEN distinct_count END",
        "uniqueness_pct": "CASE WHEN total_rows > null_count THEN "
        + text.percent("distinct_count", "total_rows")
        + " END",
        # Adding zero turns -0.0 into 0.0.
        "min_num": "min_num + 0D",
        "max_num": "max_num + 0D",
        "mean": "mean + 0D",
        "range_span": "max_num - min_num",
    }
    keys = ["run_id"] if by else []
    return long.selectExpr(*keys, *[f"{derived.get(f, f)} AS {f}" for f in PROFILE_FIELDS])


# --- counted values -------------------------------------------------------------------------

_NO_LONG, _NO_DOUBLE, _NO_TEXT = (
    "CAST(NULL AS BIGINT)",
    "CAST(NULL AS DOUBLE)",
    "CAST(NULL AS STRING)",
)


def _lanes(spec: ColumnSpec) -> tuple[str, str, str]:
    """A cell as (long, double, text); all three are null only for a null cell.

    The three fields together identify the value. A text carries its length in the first field.
    """
    cell, data_type = text.name(spec.name), spec.data_type
    if isinstance(data_type, T.IntegralType):
        return f"CAST({cell} AS BIGINT)", _NO_DOUBLE, _NO_TEXT
    if isinstance(data_type, T.DecimalType):
        return _NO_LONG, f"CAST({cell} AS DOUBLE)", f"CAST({cell} AS STRING)"
    if isinstance(data_type, T.FractionalType):
        return _NO_LONG, f"CAST({cell} AS DOUBLE)", _NO_TEXT
    if isinstance(data_type, T.BooleanType):
        return f"CAST(CAST({cell} AS INT) AS BIGINT)", _NO_DOUBLE, _NO_TEXT
    if isinstance(data_type, T.DateType):
        return f"CAST(unix_date({cell}) AS BIGINT)", _NO_DOUBLE, _NO_TEXT
    if isinstance(data_type, T.TimestampType):
        return f"unix_micros({cell})", _NO_DOUBLE, _NO_TEXT
    if isinstance(data_type, T.TimestampNTZType):
        return _micros(cell), _NO_DOUBLE, _NO_TEXT
    if spec.kind == STRING:
        return f"CAST(length({cell}) AS BIGINT)", _NO_DOUBLE, text.digest(cell)
    if not spec.countable:
        return f"CASE WHEN {cell} IS NOT NULL THEN 1L END", _NO_DOUBLE, _NO_TEXT
    if isinstance(data_type, T.BinaryType):
        return _NO_LONG, _NO_DOUBLE, f"sha2({cell}, 256)"
    if isinstance(data_type, (T.ArrayType, T.StructType)):
        value = _without_negative_zeros(cell, data_type)
        digest = f"sha2(to_json(struct({value} AS v), {_JSON_FORMATS}), 256)"
        return _NO_LONG, _NO_DOUBLE, f"CASE WHEN {cell} IS NOT NULL THEN {digest} END"
    return _NO_LONG, _NO_DOUBLE, f"CAST({cell} AS STRING)"


# Nested time stamps in full, down to the microsecond.
_JSON_FORMATS = (
    "map('timestampFormat', 'yyyy-MM-dd\\'T\\'HH:mm:ss.SSSSSSXXX',"
    " 'timestampNTZFormat', 'yyyy-MM-dd\\'T\\'HH:mm:ss.SSSSSS')"
)


def _has_fractions(data_type: T.DataType) -> bool:
    if isinstance(data_type, T.ArrayType):
        return _has_fractions(data_type.elementType)
    if isinstance(data_type, T.StructType):
        return any(_has_fractions(f.dataType) for f in data_type.fields)
    return isinstance(data_type, (T.FloatType, T.DoubleType))


def _without_negative_zeros(cell: str, data_type: T.DataType, depth: int = 0) -> str:
    """A nested value whose zeros are all written alike, as they are equal."""
    if not _has_fractions(data_type):
        return cell
    if isinstance(data_type, T.ArrayType):
        item = f"x{depth}"
        inner = _without_negative_zeros(item, data_type.elementType, depth + 1)
        return f"transform({cell}, {item} -> {inner})"
    if isinstance(data_type, T.StructType):
        fields = ", ".join(
            f"{text.literal(f.name)}, "
            + _without_negative_zeros(f"{cell}.{text.name(f.name)}", f.dataType, depth + 1)
            for f in data_type.fields
        )
        return f"CASE WHEN {cell} IS NOT NULL THEN named_struct({fields}) END"
    return f"{cell} + CAST(0 AS {data_type.simpleString()})"


def _micros(cell: str) -> str:
    """Microseconds of a time stamp without zone; a detour over the session's zone could merge two."""
    return (
        f"unix_date(CAST({cell} AS DATE)) * 86400000000L"
        f" + (hour({cell}) * 3600 + minute({cell}) * 60) * 1000000L"
        f" + CAST(extract(SECOND FROM {cell}) * 1000000 AS BIGINT)"
    )


def _column_names(df: DataFrame, specs: dict[str, list[ColumnSpec]]) -> DataFrame:
    """The profiled columns as rows of a table."""
    rows = [
        {
            "table_id": str(table_id),
            "ordinal": str(s.ordinal),
            "table_name": text.literal(table),
            "column_name": text.literal(s.name),
            "data_type": text.literal(s.type_name),
            "kind": text.literal(s.kind),
            "countable": text.literal(s.countable),
        }
        for table_id, (table, found) in enumerate(specs.items())
        for s in found
    ]
    return df.sparkSession.range(1).selectExpr(f"inline({text.structs(rows)})")


def _cells(
    tables: Mapping[str, DataFrame],
    specs: dict[str, list[ColumnSpec]],
    by: str | None,
    fields: Callable[[ColumnSpec], dict[str, str]],
) -> DataFrame:
    """A row per cell of the tables, with the number of its table and column and the given fields."""
    parts = []
    for table_id, (table, df) in enumerate(tables.items()):
        rows = [{"ordinal": str(s.ordinal)} | fields(s) for s in specs[table]]
        if rows:
            keys = [f"{text.name(by)} AS run_id"] if by else []
            parts.append(
                df.selectExpr(*keys, f"{table_id} AS table_id", f"inline({text.structs(rows)})")
            )
    return union_all(parts)


def _with_names(
    per_column: DataFrame, specs: dict[str, list[ColumnSpec]], by: str | None, figures: dict[str, str]
) -> DataFrame:
    # A table without rows has no cells to group: the list of columns keeps it in the result.
    names = _column_names(per_column, specs)
    joined = names.join(per_column, ["table_id", "ordinal"], "inner" if by else "left")
    return joined.na.fill(0, ["total_rows", "null_count"]).selectExpr(
        *(["run_id"] if by else []),
        "table_name",
        "column_name",
        "ordinal",
        "data_type",
        "kind",
        "total_rows",
        "null_count",
        *[f"{e} AS {f}" for f, e in figures.items()],
    )


_NUMBER = "coalesce(v_double, CAST(v_long AS DOUBLE))"
_PER_COLUMN = {
    "total_rows": "sum(n)",
    "null_count": "sum(CASE WHEN v_long IS NULL AND v_double IS NULL AND v_text IS NULL THEN n ELSE 0 END)",
    "distinct_values": "count(1)",
    "min_long": "min(v_long)",
    "max_long": "max(v_long)",
    "min_double": "min(v_double)",
    "max_double": "max(v_double)",
    "weighted_sum": f"sum({_NUMBER} * n)",
    "negatives": f"sum(CASE WHEN {_NUMBER} < 0 THEN n ELSE 0 END)",
    "blanks": f"sum(CASE WHEN v_text IN {BLANKS_SQL} THEN n ELSE 0 END)",
}
_MEAN = "try_divide(weighted_sum, total_rows - null_count)"
_FROM_COUNTS = {
    "distinct_count": "CASE WHEN countable THEN coalesce(distinct_values, 0) END",
    "min_num": f"CASE WHEN kind = '{NUMERIC}' THEN coalesce(min_double, CAST(min_long AS DOUBLE)) END",
    "max_num": f"CASE WHEN kind = '{NUMERIC}' THEN coalesce(max_double, CAST(max_long AS DOUBLE)) END",
    "mean": f"CASE WHEN kind = '{NUMERIC}' THEN {_MEAN} END",
    "stddev": f"CASE WHEN kind = '{NUMERIC}' THEN sqrt(try_divide(squares, total_rows - null_count - 1)) END",
    "negative_count": f"CASE WHEN kind = '{NUMERIC}' THEN coalesce(negatives, 0) END",
    "min_len": f"CASE WHEN kind = '{STRING}' THEN CAST(min_long AS INT) END",
    "max_len": f"CASE WHEN kind = '{STRING}' THEN CAST(max_long AS INT) END",
    "avg_len": f"CASE WHEN kind = '{STRING}' THEN {_MEAN} END",
    "blank_count": f"CASE WHEN kind = '{STRING}' THEN coalesce(blanks, 0) END",
}


def _from_value_counts(
    tables: Mapping[str, DataFrame], specs: dict[str, list[ColumnSpec]], by: str | None, spread: bool
) -> DataFrame:
    lanes = {"v_long": _NO_LONG, "v_double": _NO_DOUBLE, "v_text": _NO_TEXT}
    values = {spec: dict(zip(lanes, _lanes(spec))) for found in specs.values() for spec in found}
    # A lane that no column has is neither shuffled nor compared.
    used = [lane for lane, none in lanes.items() if any(found[lane] != none for found in values.values())]
    cells = _cells(tables, specs, by, lambda spec: {lane: values[spec][lane] for lane in used})
    keys = [*(["run_id"] if by else []), "table_id", "ordinal"]
    counts = cells.groupBy(*keys, *used).agg(F.expr("count(1) AS n"))
    counts = counts.selectExpr("*", *[f"{none} AS {lane}" for lane, none in lanes.items() if lane not in used])
    per_column = counts.groupBy(*keys).agg(*[F.expr(f"{e} AS {f}") for f, e in _PER_COLUMN.items()])
    if not spread:
        return _with_names(per_column, specs, by, _FROM_COUNTS | {"stddev": _NO_DOUBLE})
    # Squares around the mean: the counts, which are shuffled once, are read a second time.
    means = per_column.where("weighted_sum IS NOT NULL").selectExpr(
        *[f"{k} AS of_{k}" for k in keys], f"{_MEAN} AS center"
    )
    same = " AND ".join(f"{k} <=> of_{k}" for k in keys)
    squares = (
        counts.selectExpr(*keys, f"{_NUMBER} AS number", "n")
        .where("number IS NOT NULL")
        .join(means, F.expr(same))
        .groupBy(*[F.col(f"of_{k}") for k in keys])
        .agg(F.expr("sum(n * pow(number - center, 2)) AS squares"))
    )
    figured = per_column.join(squares, F.expr(same), "left").drop(*[f"of_{k}" for k in keys])
    return _with_names(figured, specs, by, _FROM_COUNTS)


# --- grouped cells --------------------------------------------------------------------------

# Statistic: its group, the kind of column that has it, its type and its aggregate.
_GROUPED = {
    "min_num": (RANGE, NUMERIC, "DOUBLE", "min(number)"),
    "max_num": (RANGE, NUMERIC, "DOUBLE", "max(number)"),
    "mean": (RANGE, NUMERIC, "DOUBLE", "avg(number)"),
    "stddev": (SPREAD, NUMERIC, "DOUBLE", "stddev(number)"),
    "negative_count": (SIGNS, NUMERIC, "BIGINT", "count_if(number < 0)"),
    "min_len": (LENGTHS, STRING, "INT", "min(length)"),
    "max_len": (LENGTHS, STRING, "INT", "max(length)"),
    "avg_len": (LENGTHS, STRING, "DOUBLE", "avg(length)"),
    "blank_count": (BLANKS, STRING, "BIGINT", "count_if(blank)"),
}


def _from_grouped_cells(
    tables: Mapping[str, DataFrame],
    specs: dict[str, list[ColumnSpec]],
    by: str | None,
    stats: frozenset[str],
    estimate: bool,
) -> DataFrame:
    def fields(spec: ColumnSpec) -> dict[str, str]:
        cell = text.name(spec.name)
        numeric, string = spec.kind == NUMERIC, spec.kind == STRING
        found = {"missing": f"{cell} IS NULL"}
        if stats & {RANGE, SPREAD, SIGNS}:
            found["number"] = f"CAST({cell} AS DOUBLE)" if numeric else _NO_DOUBLE
        if LENGTHS in stats:
            found["length"] = f"length({cell})" if string else "CAST(NULL AS INT)"
        if BLANKS in stats:
            found["blank"] = f"{cell} IN {BLANKS_SQL}" if string else "CAST(NULL AS BOOLEAN)"
        if estimate:
            # Null counts as one value. An empty array alone would hash like null.
            found["hash"] = f"xxhash64({cell}, {cell} IS NULL)" if spec.countable else _NO_LONG
        return found

    wanted = {f: e for f, (group, _, _, e) in _GROUPED.items() if group in stats}
    if estimate:
        wanted["distinct_values"] = "approx_count_distinct(hash, 0.02)"
    per_column = (
        _cells(tables, specs, by, fields)
        .groupBy(*(["run_id"] if by else []), "table_id", "ordinal")
        .agg(
            F.expr("count(1) AS total_rows"),
            F.expr("count_if(missing) AS null_count"),
            *[F.expr(f"{e} AS {f}") for f, e in wanted.items()],
        )
    )
    distinct = "CASE WHEN countable THEN coalesce(distinct_values, 0) END" if estimate else _NO_LONG
    figures = {"distinct_count": distinct}
    for field, (_, kind, type_name, _) in _GROUPED.items():
        value = field if field in wanted else f"CAST(NULL AS {type_name})"
        if field in ("negative_count", "blank_count") and field in wanted:
            value = f"coalesce({field}, 0)"
        figures[field] = f"CASE WHEN kind = '{kind}' THEN {value} END"
    return _with_names(per_column, specs, by, figures)


# --- one aggregate --------------------------------------------------------------------------

_STAT_TYPES = {
    "non_null": "BIGINT",
    "distinct_count": "BIGINT",
    "min_num": "DOUBLE",
    "max_num": "DOUBLE",
    "mean": "DOUBLE",
    "stddev": "DOUBLE",
    "negative_count": "BIGINT",
    "min_len": "INT",
    "max_len": "INT",
    "avg_len": "DOUBLE",
    "blank_count": "BIGINT",
}


def _aggregates(spec: ColumnSpec, stats: frozenset[str]) -> dict[str, str]:
    cell = text.name(spec.name)
    # All plans average doubles, so that a mean does not depend on the plan.
    number = f"CAST({cell} AS DOUBLE)"
    found = {"non_null": f"count({cell})"}
    if spec.kind == NUMERIC:
        if RANGE in stats:
            found |= {"min_num": f"min({cell})", "max_num": f"max({cell})", "mean": f"avg({number})"}
        if SPREAD in stats:
            found["stddev"] = f"stddev({number})"
        if SIGNS in stats:
            found["negative_count"] = f"count_if({cell} < 0)"
    elif spec.kind == STRING:
        if LENGTHS in stats:
            length = f"length({cell})"
            found |= {"min_len": f"min({length})", "max_len": f"max({length})", "avg_len": f"avg({length})"}
        if BLANKS in stats:
            found["blank_count"] = f"count_if({cell} IN {BLANKS_SQL})"
    return found


def _from_aggregates(
    tables: Mapping[str, DataFrame],
    specs: dict[str, list[ColumnSpec]],
    by: str | None,
    stats: frozenset[str],
) -> DataFrame:
    wanted = {t: {s: _aggregates(s, stats) for s in found} for t, found in specs.items()}
    wide = {t for t, found in wanted.items() if sum(map(len, found.values())) > WIDEST_AGGREGATE}
    parts = [_aggregated(df, t, wanted[t], by) for t, df in tables.items() if t not in wide and specs[t]]
    if wide:
        chosen = {t: df for t, df in tables.items() if t in wide}
        grouped = _from_grouped_cells(chosen, {t: specs[t] for t in chosen}, by, stats, estimate=False)
        parts.append(grouped)
    return union_all(parts)


def _aggregated(
    df: DataFrame, table: str, wanted: dict[ColumnSpec, dict[str, str]], by: str | None
) -> DataFrame:
    # All statistics are fields of one struct, so that they are one expression to build.
    fields = {f"{spec.ordinal}_{s}": e for spec, found in wanted.items() for s, e in found.items()}
    figures = ", ".join(f"{text.literal(f)}, {e}" for f, e in fields.items())
    groups = [F.expr(f"{text.name(by)} AS run_id")] if by else []
    one_row = df.groupBy(*groups).agg(
        F.expr("count(1) AS total_rows"), F.expr(f"named_struct({figures}) AS figures")
    )
    rows = [
        {
            "column_name": text.literal(spec.name),
            "ordinal": str(spec.ordinal),
            "data_type": text.literal(spec.type_name),
            "kind": text.literal(spec.kind),
        }
        | {
            s: f"CAST({f'figures.`{spec.ordinal}_{s}`' if s in found else 'NULL'} AS {kind})"
            for s, kind in _STAT_TYPES.items()
        }
        for spec, found in wanted.items()
    ]
    long = one_row.selectExpr(
        *(["run_id"] if by else []),
        f"{text.literal(table)} AS table_name",
        "total_rows",
        f"inline({text.structs(rows)})",
    )
    return long.withColumn("null_count", F.expr("total_rows - non_null")).drop("non_null")


# --- long form ------------------------------------------------------------------------------

LONG_STATS = (
    "total_rows",
    "null_count",
    "null_pct",
    "non_null_count",
    "distinct_count",
    "uniqueness_pct",
    "min_num",
    "max_num",
    "mean",
    "range_span",
    "stddev",
    "negative_count",
    "min_len",
    "max_len",
    "avg_len",
    "blank_count",
    "data_quality_score",
)


def profile_long(profile: DataFrame, keys: Iterable[str] = ("table_name", "column_name")) -> DataFrame:
    """Numeric statistics of a profile as rows ``(keys…, stat, value)``; missing ones are left out."""
    present = [s for s in LONG_STATS if s in profile.columns]
    wide = profile.selectExpr(*keys, *[f"CAST({s} AS DOUBLE) AS {s}" for s in present])
    return wide.unpivot(list(keys), present, "stat", "value").where("value IS NOT NULL")
