"""Rules between rows and tables, compiled so that rules about one key share one shuffle.

Rules that ask about the same key of the same table form a *domain*: its primary key, the foreign keys and
lookups that refer to it, and the sequence that counts within it. Every rule marks its rows by key, the marks
of all rules are added up per key in one grouping (after partial sums in the tasks that read the rows), and the
figures of all rules are one aggregate over the sums. A key that fills a large part of a table is one
row per task before the shuffle. Date order compares single rows and is a plan of its own.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.functions import text
from plumbline.functions.frames import union_all
from plumbline.functions.schema import resolve
from plumbline.operators.integrity import date_order_check, key_of
from plumbline.plans.policy import DateOrder, TableRules


@dataclass
class Mark:
    """Rows of a table that count towards a key: the cells of the key, and which of them count."""

    table: str
    cells: list[str]
    where: str = "true"


@dataclass
class Figure:
    """A rule's figure over the keys of a domain, in SQL over the sums of marks ``m0``, ``m1`` and so on."""

    table: str
    column: str
    check_type: str
    aggregate: str
    threshold: str


@dataclass
class Domain:
    """A key of a table with all rules about it."""

    table: str
    key: tuple[str, ...]
    marks: list[Mark] = field(default_factory=list)
    figures: list[Figure] = field(default_factory=list)

    @property
    def name(self) -> str:
        return f"{self.table}.{'+'.join(self.key)}"

    def mark(self, mark: Mark) -> str:
        """The sum of a mark; equal marks are one."""
        if mark not in self.marks:
            self.marks.append(mark)
        return f"m{self.marks.index(mark)}"


def _skip(table: str, column: str, check_type: str, reason: str) -> tuple:
    return (table, column, check_type, "SKIP", reason, None, None)


def compile_relations(
    tables: Mapping[str, DataFrame], rules: Mapping[str, TableRules]
) -> tuple[list[Domain], list[tuple[str, DateOrder]], list[tuple]]:
    """The domains of all rules, the rules on date order, and a SKIP row for each rule that lacks a table or column."""
    domains: dict[tuple, Domain] = {}
    orders, skipped = [], []

    def domain(table: str, key: Iterable[str]) -> Domain:
        at = (table, tuple(key))
        return domains.setdefault(at, Domain(*at))

    def cell(table: str, column: str) -> str:
        return key_of(text.name(column), tables[table].schema[column].dataType)

    for name, rule in rules.items():
        if name not in tables:
            continue
        key = [resolve(tables[name], c) for c in rule.primary_key]
        if key and None not in key:
            own = domain(name, key)
            count = own.mark(Mark(name, [cell(name, c) for c in key]))
            own.figures.append(
                Figure(name, ", ".join(key), "primary_key", f"count_if({count} > 1)", "0 duplicates")
            )
        for ref in rule.references:
            column = resolve(tables[name], ref.column)
            parent = tables.get(ref.parent)
            target = resolve(parent, ref.key) if parent is not None else None
            if column is None or target is None:
                lacks = f"no such column: {ref.parent}.{ref.key}"
                if column is None:
                    lacks = "no such column"
                elif parent is None:
                    lacks = f"no such table: {ref.parent}"
                skipped.append(_skip(name, ref.column, ref.check_type, lacks))
                continue
            shared = domain(ref.parent, [target])
            held = shared.mark(Mark(ref.parent, [cell(ref.parent, target)]))
            asked = shared.mark(Mark(name, [cell(name, column)], f"{text.name(column)} IS NOT NULL"))
            shared.figures.append(
                Figure(
                    name, column, ref.check_type,
                    f"coalesce(sum(CASE WHEN {held} = 0 THEN {asked} END), 0)",
                    f"all in {ref.parent}.{target}",
                )
            )
        for sequence in rule.sequences:
            position = resolve(tables[name], sequence.position)
            group = resolve(tables[name], sequence.group) if sequence.group else None
            if position is None or (sequence.group and group is None):
                skipped.append(_skip(name, sequence.position, "sequence", "no such column"))
                continue
            grouped = [group] if group else []
            own = domain(name, [*grouped, position])
            number, there = text.name(position), f"{text.name(position)} IS NOT NULL"
            cells = [cell(name, c) for c in grouped]
            present = own.mark(Mark(name, [*cells, cell(name, position)]))
            announced = own.mark(Mark(name, [*cells, f"{number} + 1"], there))
            # Each run of numbers starts at one without a predecessor; a whole sequence has one start.
            start = f"{present} > 0 AND {announced} = 0 AND k{len(cells)} IS NOT NULL"
            whole = f"count(DISTINCT CASE WHEN {start} THEN struct(k0) END)" if cells else f"least(1, count_if({start}))"
            own.figures.append(Figure(name, position, "sequence", f"count_if({start}) - {whole}", "0 gaps"))
        for order in rule.date_orders:
            parent = tables.get(order.parent)
            wanted = [(name, order.later), (name, order.on[0])]
            if parent is None:
                skipped.append(_skip(name, order.later, "date_order", f"no such table: {order.parent}"))
                continue
            wanted += [(order.parent, order.earlier), (order.parent, order.on[1])]
            absent = [f"{t}.{c}" for t, c in wanted if resolve(tables[t], c) is None]
            if absent:
                skipped.append(_skip(name, order.later, "date_order", f"no such column: {', '.join(absent)}"))
                continue
            orders.append((name, order))
    return list(domains.values()), orders, skipped


_COLUMNS = ("table_name", "column_name", "check_type", "status", "threshold", "actual", "latest")


def evaluate_domain(tables: Mapping[str, DataFrame], domain: Domain) -> DataFrame:
    """All rules of a domain: one shuffle by key, then one row."""
    keys = [f"k{i}" for i in range(len(domain.key))]
    parts = []
    for i, mark in enumerate(domain.marks):
        marks = [f"{int(i == j)}L AS m{j}" for j in range(len(domain.marks))]
        cells = [f"{cell} AS {key}" for cell, key in zip(mark.cells, keys)]
        parts.append(tables[mark.table].where(mark.where).selectExpr(*cells, *marks))
    sums = union_all(parts).groupBy(*keys).agg(*[F.sum(f"m{j}").alias(f"m{j}") for j in range(len(parts))])
    figures = ", ".join(f"'{i}', CAST({f.aggregate} AS BIGINT)" for i, f in enumerate(domain.figures))
    rows = [
        {
            "table_name": text.literal(f.table),
            "column_name": text.literal(f.column),
            "check_type": text.literal(f.check_type),
            "status": f"CASE WHEN figures.`{i}` = 0 THEN 'PASS' ELSE 'FAIL' END",
            "threshold": text.literal(f.threshold),
            "actual": f"CAST(figures.`{i}` AS DOUBLE)",
            "latest": text.NO_TEXT,
        }
        for i, f in enumerate(domain.figures)
    ]
    return sums.agg(F.expr(f"named_struct({figures}) AS figures")).selectExpr(f"inline({text.structs(rows)})")


def evaluate_order(tables: Mapping[str, DataFrame], name: str, order: DateOrder) -> DataFrame:
    child, parent = tables[name], tables[order.parent]
    columns = (resolve(child, order.on[0]), resolve(parent, order.on[1]))
    later, earlier = resolve(child, order.later), resolve(parent, order.earlier)
    spread = [c for c in (resolve(child, s) for s in order.spread_by) if c]
    found = date_order_check(child, parent, columns, later, earlier, name, spread)
    return found.selectExpr(
        "table_name",
        f"{text.literal(later)} AS column_name",
        "check_type",
        "status",
        f"{text.literal(f'not before {order.parent}.{earlier}')} AS threshold",
        "CAST(violations AS DOUBLE) AS actual",
        f"{text.NO_TEXT} AS latest",
    )


def skipped_rows(spark, skipped: list[tuple]) -> DataFrame:
    rows = [dict(zip(_COLUMNS, map(_value, row))) for row in skipped]
    return spark.range(1).selectExpr(f"inline({text.structs(rows)})")


def _value(value: str | None) -> str:
    return text.NO_TEXT if value is None else text.literal(value)


def evaluate_relations(tables: Mapping[str, DataFrame], rules: Mapping[str, TableRules]) -> list[DataFrame]:
    """Results of all rules between rows and tables, a plan per domain and per rule on date order."""
    domains, orders, skipped = compile_relations(tables, rules)
    parts = [evaluate_domain(tables, d) for d in domains]
    parts += [evaluate_order(tables, name, order) for name, order in orders]
    if skipped:
        spark = next(iter(tables.values())).sparkSession
        found = skipped_rows(spark, skipped)
        parts.append(found.withColumn("actual", F.col("actual").cast("double")))
    return parts

