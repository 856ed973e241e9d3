"""Rules from a JSON configuration, compiled to one aggregate per table."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, replace
from importlib import resources

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions import text
from plumbline.functions.frames import union_all
from plumbline.functions.schema import resolve
from plumbline.operators.table_checks import timestamp_column
from plumbline.plans.policy import (
    CRITICAL_NULL_PCT,
    FRESHNESS_HOURS,
    DateOrder,
    Range,
    Reference,
    RunSettings,
    Sequence,
    TableRules,
)
from plumbline.plans.relations import evaluate_relations


# What stands for the table in the row of a rule that concerns none of them.
ALL_TABLES = "*"


def read_config(spark: SparkSession, path: str) -> dict:
    """A configuration on any file system Spark reads: one small file, parsed on the driver."""
    files = spark.read.text(path, wholetext=True).take(2)
    if len(files) != 1:
        raise ValueError(f"{path} should hold one rule file")
    return json.loads(files[0]["value"])


def read_rules(spark: SparkSession, path: str) -> dict[str, TableRules]:
    return parse_rules(read_config(spark, path))


def parse_sources(config: Mapping) -> dict[str, str]:
    """Where the tables of a configuration lie, for those that name a path."""
    return {
        table: entry["path"]
        for source in config.get("data_sources", {}).values()
        for table, entry in source["tables"].items()
        if entry.get("path")
    }


def parse_settings(config: Mapping) -> RunSettings:
    """Limits of alerts and days of retention, where a configuration names them."""
    alerts = config.get("monitoring", {}).get("alert_threshold", {})
    usual = RunSettings()
    return RunSettings(
        float(alerts.get("failed_checks_percentage", usual.failed_checks_pct)),
        int(alerts.get("consecutive_failures", usual.consecutive_failures)),
        int(config.get("reporting", {}).get("retention_days", usual.retention_days)),
    )


def packaged_rules(name: str) -> dict[str, TableRules]:
    """Rules that come with the package."""
    found = resources.files("plumbline.plans").joinpath(f"{name}.json").read_text("utf-8")
    return parse_rules(json.loads(found))


def parse_rules(config: Mapping) -> dict[str, TableRules]:
    """Table entries of a configuration joined with its general rules.

    A general rule that is switched off, or missing, applies to no table.
    """
    general = config.get("dq_rules", {})

    def rule(name: str) -> Mapping:
        found = general.get(name, {})
        return found if found.get("enabled", True) else {}

    volume, nulls, fresh = rule("volume"), rule("null_checks"), rule("freshness")
    bounds = rule("range_checks").get("numeric_ranges", {})
    result = {}
    for source in config.get("data_sources", {}).values():
        for table, entry in source["tables"].items():
            limits = None
            if volume:
                limits = Range(
                    entry.get("volume_min", volume.get("min_records", 0)),
                    entry.get("volume_max", volume.get("max_records", 2**62)),
                )
            key = entry.get("primary_key", ())
            result[table] = TableRules(
                volume=limits,
                critical=tuple(nulls.get("critical_columns", ())),
                max_null_pct=float(nulls.get("max_null_percentage", CRITICAL_NULL_PCT)),
                ranges={c: Range(r["min"], r["max"]) for c, r in bounds.items()},
                patterns=dict(rule("pattern_checks").get("patterns", {})),
                primary_key=(key,) if isinstance(key, str) else tuple(key),
                types=dict(entry.get("types", {})),
                references=tuple(
                    Reference(column, *target.rsplit(".", 1), kind)
                    for kind, named in (("foreign_key", "foreign_keys"), ("lookup", "lookups"))
                    for column, target in entry.get(named, {}).items()
                ),
                sequences=tuple(Sequence(position, group) for position, group in entry.get("sequences", {}).items()),
                date_orders=tuple(
                    DateOrder(
                        later,
                        *order["not_before"].rsplit(".", 1),
                        tuple(order["on"]),
                        tuple(order.get("spread_by", ())),
                    )
                    for later, order in entry.get("date_order", {}).items()
                ),
                freshness_hours=float(
                    entry.get("freshness_threshold_hours", fresh.get("max_age_hours", FRESHNESS_HOURS))
                )
                if fresh
                else None,
                timestamp_column=entry.get("timestamp_column"),
                general=True,
            )
    return result


@dataclass(frozen=True)
class Check:
    """A rule as an aggregate, the figure reported from it, and the condition to pass, as SQL text.

    In figure and condition ``$`` stands for the aggregate. Aggregates of parts of a table are put together
    by ``merge``.
    """

    check_type: str
    column: str | None
    aggregate: str
    actual: str
    passed: str
    threshold: str
    status_of_none: str = "SKIP"
    merge: str = "sum"

    @property
    def key(self) -> str:
        """A name that stays when other rules come or go."""
        return f"{self.check_type}:{self.column or ''}"

    def result(self, figure: str) -> dict[str, str]:
        passed, actual = self.passed.replace("$", figure), self.actual.replace("$", figure)
        return {
            "column_name": f"CAST({text.literal(self.column)} AS STRING)",
            "check_type": text.literal(self.check_type),
            # Without any time stamp the aggregate is null.
            "status": f"CASE WHEN {figure} IS NULL THEN '{self.status_of_none}' "
            f"WHEN {passed} THEN 'PASS' ELSE 'FAIL' END",
            "threshold": text.literal(self.threshold),
            "actual": f"CAST({actual} AS DOUBLE)",
        }

    def latest(self, figure: str) -> dict[str, str]:
        """The latest time stamp, where the rule is about one."""
        found = f"date_format(timestamp_micros({figure}), 'yyyy-MM-dd HH:mm:ss')"
        return {"latest": found if self.merge == "max" else text.NO_TEXT}


def _column_rules(rule: TableRules) -> list[tuple[str, str]]:
    """Check and column of every rule that a table must be able to answer."""
    return [
        *(("null_checks", c) for c in rule.critical),
        *(("range_checks", c) for c in rule.ranges),
        *(("pattern", c) for c in rule.patterns),
        *(("castable", c) for c in rule.types),
    ]


def _skipped(check_type: str, column: str | None, reason: str) -> dict[str, str]:
    return {
        "column_name": f"CAST({text.literal(column)} AS STRING)",
        "check_type": text.literal(check_type),
        "status": "'SKIP'",
        "threshold": text.literal(reason),
        "actual": "CAST(NULL AS DOUBLE)",
        "latest": text.NO_TEXT,
    }


def rule_units(rule: TableRules) -> list[tuple[str, str | None]]:
    """The single rules of a table, as check and column."""
    units: list[tuple[str, str | None]] = [("volume", None)] if rule.volume else []
    units += [("watched_nulls", c) for c in rule.watched if c not in rule.critical]
    units += _column_rules(rule)
    if rule.freshness_hours is not None:
        units.append(("freshness", rule.timestamp_column))
    return units


def only(rule: TableRules, units: Iterable[tuple[str, str | None]]) -> TableRules:
    """The rules of a table reduced to some of its single rules."""
    kept = set(units)

    def of(check_type: str, columns: Iterable[str]) -> list[str]:
        return [c for c in columns if (check_type, c) in kept]

    kinds = {kind for kind, _ in kept}
    return replace(
        rule,
        volume=rule.volume if "volume" in kinds else None,
        critical=tuple(of("null_checks", rule.critical)),
        watched=tuple(of("watched_nulls", rule.watched)),
        ranges={c: rule.ranges[c] for c in of("range_checks", rule.ranges)},
        patterns={c: rule.patterns[c] for c in of("pattern", rule.patterns)},
        types={c: rule.types[c] for c in of("castable", rule.types)},
        freshness_hours=rule.freshness_hours if "freshness" in kinds else None,
    )


def unmatched_rules(tables: Mapping[str, DataFrame], rules: Mapping[str, TableRules]) -> list[tuple]:
    """Check and column of the general rules that no column of any table answers to."""
    wanted: dict[tuple[str, str], bool] = {}
    for name, rule in rules.items():
        if rule.general and name in tables:
            for check_type, column in _column_rules(rule):
                found = resolve(tables[name], column) is not None
                wanted[check_type, column] = wanted.get((check_type, column), False) or found
    return [key for key, found in wanted.items() if not found]


def compile_checks(df: DataFrame, rule: TableRules, as_of: str | None) -> list[Check]:
    """The checks of a table, without rules for columns that it does not have."""
    checks = []
    share = text.percent("$", "total_rows")
    if rule.volume:
        low, high = int(rule.volume.low), int(rule.volume.high)
        checks.append(
            Check("volume", None, "count(1)", "$", f"$ BETWEEN {low}L AND {high}L", f"{low}..{high}")
        )
    watched = [c for c in rule.watched if c not in rule.critical]
    limits = [(c, rule.max_null_pct) for c in rule.critical]
    limits += [(c, rule.max_watched_null_pct) for c in watched]
    for named, limit in limits:
        if column := resolve(df, named):
            missing = f"count_if({text.name(column)} IS NULL)"
            checks.append(
                Check("null_checks", column, missing, share, f"{share} <= {limit}", f"<={limit:g}%")
            )
    for named, bounds in rule.ranges.items():
        if column := resolve(df, named):
            cell, limit = text.name(column), rule.range_tolerance_pct
            outside = f"count_if({cell} < {bounds.low} OR {cell} > {bounds.high})"
            checks.append(
                Check("range_checks", column, outside, share, f"{share} <= {limit}", f"<={limit:g}%")
            )
    for named, pattern in rule.patterns.items():
        if column := resolve(df, named):
            broken = f"count_if(NOT {text.name(column)} RLIKE {text.literal(pattern)})"
            limit = rule.pattern_tolerance_pct
            checks.append(
                Check("pattern", column, broken, share, f"{share} <= {limit}", f"<={limit:g}%")
            )
    for named, type_name in rule.types.items():
        if column := resolve(df, named):
            cell = text.name(column)
            broken = f"count_if({cell} IS NOT NULL AND try_cast({cell} AS {type_name}) IS NULL)"
            checks.append(Check("castable", column, broken, "$", "$ = 0", f"0 values that are no {type_name}"))
    if rule.freshness_hours is not None and as_of is not None:
        checks.append(_compile_freshness(df, rule, as_of))
    return checks


def _compile_freshness(df: DataFrame, rule: TableRules, as_of: str) -> Check:
    limit = rule.freshness_hours
    column = resolve(df, rule.timestamp_column) if rule.timestamp_column else timestamp_column(df)
    threshold = f"<={limit:g}h"
    if column is None:
        status = rule.no_timestamp_status
        return Check("freshness", None, "CAST(any_value(NULL) AS BIGINT)", "$", "true", threshold, status)
    cell = text.name(column)
    if isinstance(df.schema[column].dataType, T.StringType):
        cell = f"try_to_timestamp({cell})"
    latest = f"unix_micros(CAST(max({cell}) AS TIMESTAMP))"
    age = f"((unix_micros(CAST({text.literal(as_of)} AS TIMESTAMP)) - $) / 3.6e9D)"
    return Check(
        "freshness", column, latest, age, f"{age} <= {limit}", threshold, rule.no_value_status, "max"
    )


def _evaluate(
    df: DataFrame, table: str, rule: TableRules, as_of: str | None, by: str | None
) -> list[DataFrame]:
    parts = []
    checks = compile_checks(df, rule, as_of)
    keys = ["run_id"] if by else []
    skipped = []
    if not rule.general:
        skipped = [
            _skipped(check_type, column, "no such column")
            for check_type, column in _column_rules(rule)
            if resolve(df, column) is None
        ]
    absent = [c for c in rule.primary_key if resolve(df, c) is None]
    if absent and not by:
        # A part of the key says nothing about the whole.
        reason = f"no such column: {', '.join(absent)}"
        skipped.append(_skipped("primary_key", ", ".join(rule.primary_key), reason))
    if not checks and not skipped and (by or not rule.relations):
        skipped.append(_skipped("rules", None, "nothing to check"))
    if checks or skipped:
        figures = ", ".join(["'rows', count(1)", *(f"'{i}', {c.aggregate}" for i, c in enumerate(checks))])
        rows = [c.result(f"figures.`{i}`") | c.latest(f"figures.`{i}`") for i, c in enumerate(checks)] + skipped
        groups = [F.expr(f"{text.name(by)} AS run_id")] if by else []
        wide = df.groupBy(*groups).agg(
            F.expr("count(1) AS total_rows"), F.expr(f"named_struct({figures}) AS figures")
        )
        parts.append(
            wide.selectExpr(
                *keys, f"{text.literal(table)} AS table_name", f"inline({text.structs(rows)})"
            )
        )
    return parts


def evaluate_rules(
    tables: Mapping[str, DataFrame],
    rules: Mapping[str, TableRules],
    as_of: str | None = None,
    by: str | None = None,
    unmatched: bool = True,
    relations: bool = True,
) -> DataFrame:
    """All configured checks of all tables, as one plan of result rows.

    Names are resolved as the session does. A rule of a table for a column that it does not have is
    skipped, with a row; so is, once for all tables and unless ``unmatched`` is off, a general rule
    that no table answers to.

    A table is scanned once for all its rules, and once more for each of its keys that rules are about. ``by``
    names a column that splits the tables into runs; each run is judged on its own, without keys and other
    ``relations``.
    """

    parts = []
    for name, rule in rules.items():
        if name in tables:
            parts += _evaluate(tables[name], name, rule, as_of, by)
    if relations and not by:
        parts += evaluate_relations(tables, rules)
    missing = unmatched_rules(tables, rules) if unmatched and not by else []
    if missing:
        rows = [_skipped(check_type, column, "no table has this column") for check_type, column in missing]
        single = next(iter(tables.values())).sparkSession.range(1)
        parts.append(
            single.selectExpr(f"{text.literal(ALL_TABLES)} AS table_name", f"inline({text.structs(rows)})")
        )
    return union_all(parts)
