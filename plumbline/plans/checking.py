"""The rule run: which tables exist, what the rules say of them, and the status of it all."""

from __future__ import annotations

import datetime
import re
from collections.abc import Callable, Mapping, Sequence
from functools import partial

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.functions.frames import NothingToDo
from plumbline.functions.jobs import FAILURES, bisected, error_name, is_missing, side_by_side
from plumbline.functions.schema import resolve
from plumbline.operators.checks import literal_rows
from plumbline.operators.report import check_lines
from plumbline.operators.rollup import (
    FAIL_FIRST,
    consecutive_failures,
    expected_volumes,
    failed_share_alert,
    rollup_checks,
    rollup_run,
    rollup_tables,
)
from plumbline.plans.policy import DEFAULT_VOLUME, RunSettings, TableRules
from plumbline.plans.publishing import publish
from plumbline.plans.relations import Figure, compile_relations, evaluate_domain, evaluate_order
from plumbline.plans.rules import ALL_TABLES, evaluate_rules, only, rule_units, unmatched_rules
from plumbline.sources import load_source, write_csv, write_documents, write_lines
from plumbline.sources.lanes import read_lanes

RESULT = (
    "table_name string, column_name string, check_type string, status string, threshold string, "
    "actual double, latest string, message string"
)


def run_checks(
    spark: SparkSession,
    refs: Mapping[str, str],
    rules: Mapping[str, TableRules],
    out: str,
    run_id: str,
    as_of: str,
    precedence: tuple[str, ...] = FAIL_FIRST,
    settings: RunSettings = RunSettings(),
    split_rows: bool = False,
) -> dict[str, str]:
    """Evaluate the rules of every table and write results and statuses below ``out``.

    A missing table is SKIPPED. A rule that cannot be judged is found by halving its table's rules and becomes
    an ERROR row beside the results of the others; so does a table that cannot be read. A table
    without rules is held to the default limits of its volume. The results are stored table by table;
    everything else is derived from what was stored. Alerts look at all stored runs: too large a share
    of failed checks in this run, and series of failures that reach it.

    Of a CSV the lines that do not fit its header are kept aside with file and text; they are an ERROR row of the
    table, and its other lines are judged.

    ``split_rows`` also stores the rows of every table with critical columns, accepted and rejected apart, and
    publishes them below ``out/rows/<table>`` under the run; a failure there is an ERROR row of the table.
    """
    unlisted = {name: TableRules(volume=DEFAULT_VOLUME, freshness_hours=None) for name in refs if name not in rules}
    rules = {**rules, **unlisted}
    parts = ("results", "checks", "tables", "run", "by_check", "alerts", "summary", "expected", "malformed")
    paths = {part: f"{out.rstrip('/')}/{part}/run_id={run_id}" for part in parts}
    targets, tables, missing, errors, lanes = {}, {}, [], {}, {}
    for name in rules:
        try:
            if refs[name].endswith(".csv"):
                tables[name], lanes[name] = read_lanes(spark, refs[name])
            else:
                tables[name] = load_source(spark, refs[name])
            targets[name] = f"{paths['results']}/source={name}"
        except KeyError:
            missing.append(name)
        except FAILURES as error:
            if is_missing(error):
                missing.append(name)
            else:
                errors[name] = error_name(error)

    stored: dict[str, str] = {}
    unjudged: dict[tuple, str] = {}

    def store(name: str) -> None:
        units = rule_units(rules[name])

        def store_rules(part: Sequence[tuple]) -> None:
            chosen = rules[name] if len(part) == len(units) else only(rules[name], part)
            try:
                found = evaluate_rules({name: tables[name]}, {name: chosen}, as_of, unmatched=False, relations=False)
            except NothingToDo:  # all its rules are relations
                return
            _told(found).write.mode("append" if name in stored else "overwrite").parquet(targets[name])
            stored[name] = targets[name]

        try:
            store_rules(units)
        except FAILURES as error:
            # A table that cannot even be counted has no rule to blame.
            tables[name].select(F.lit(1)).groupBy().count().first()
            if not units:
                raise error
            half = max(1, len(units) // 2)
            for part in (units[:half], units[half:]):
                _, failed = bisected(store_rules, part)
                unjudged.update({(name, column, kind): e for (kind, column), e in failed.items()})

    errors |= side_by_side({name: partial(store, name) for name in tables})
    related, unrelated = _relation_jobs(tables, rules, paths["results"])
    failed = side_by_side({at: job for at, (job, _) in related.items()})
    for at, error in failed.items():
        unjudged.update({(f.table, f.column, f.check_type): error for f in related[at][1]})
    stored |= {at: at for at in related if at not in failed}
    lines: dict[str, int] = {}

    def keep_lines(name: str) -> None:
        kept = f"{paths['malformed']}/source={name}"
        lanes[name].write.mode("overwrite").parquet(kept)
        lines[name] = spark.read.schema(lanes[name].schema).parquet(kept).count()

    errors |= side_by_side({name: partial(keep_lines, name) for name in lanes if name not in errors})
    unsplit = {}
    if split_rows:
        critical = {name: [c for c in (resolve(df, c) for c in rules[name].critical) if c] for name, df in tables.items()}
        unsplit = side_by_side(
            {
                name: partial(publish, tables[name], critical[name], f"{out.rstrip('/')}/rows/{name}", run_id)
                for name in tables
                if critical[name] and name not in errors
            }
        )
    written = list(stored.values())
    broken = [(name, None, "evaluation", "ERROR", None, None, None, e) for name, e in errors.items()]
    broken += [
        (name, None, "malformed_rows", "ERROR", "0 lines", float(n), None, f"{n} lines that do not fit the header")
        for name, n in lines.items()
        if n
    ]
    broken += [(name, None, "split_rows", "ERROR", None, None, None, e) for name, e in unsplit.items()]
    broken += [
        (name, column, "null_checks" if kind == "watched_nulls" else kind, "ERROR", None, None, None, e)
        for (name, column, kind), e in unjudged.items()
    ]
    broken += [
        (ALL_TABLES, column, check_type, "SKIP", "no table has this column", None, None, None)
        for check_type, column in unmatched_rules(tables, rules)
    ]
    broken += [(*row, None) for row in unrelated]
    results = _results(spark, written, broken)
    checks = rollup_checks(results)
    statuses = rollup_tables(checks, precedence)
    if missing:
        skipped = literal_rows(
            spark,
            [(name, 0, "SKIPPED") for name in missing],
            "table_name string, checks bigint, overall_status string",
        )
        statuses = statuses.unionByName(skipped)
    write_csv(checks, paths["checks"])
    write_csv(statuses, paths["tables"])
    write_documents(rollup_run(statuses), paths["run"])
    results.repartition("check_type").write.mode("overwrite").option("header", True).partitionBy(
        "check_type"
    ).csv(paths["by_check"])
    write_lines(check_lines(results, statuses, "DATA QUALITY REPORT", as_of), paths["summary"])
    history = stored_results(spark, out).unionByName(
        literal_rows(spark, broken, RESULT).withColumn("run_id", F.lit(run_id))
        if broken
        else spark.createDataFrame([], f"{RESULT}, run_id string")
    )
    write_documents(alerts(history, run_id, settings), paths["alerts"])
    write_documents(expected(history).where(F.col("run_id") == run_id), paths["expected"])
    return paths


def _told(found: DataFrame) -> DataFrame:
    """The results with a message for everything that did not pass."""
    told = F.concat_ws(
        " ", "check_type", "column_name", F.lit("is"), F.col("actual").cast("string"), F.lit("against"), "threshold"
    )
    return found.withColumn("message", F.when(F.col("status") != "PASS", told))


def _relation_jobs(
    tables: Mapping[str, DataFrame], rules: Mapping[str, TableRules], results: str
) -> tuple[dict[str, tuple], list[tuple]]:
    """A job per key that rules are about, and per rule on date order, by the folder it writes; each with the rules
    that fail if it does. And the rules that lack a table or a column."""
    domains, orders, skipped = compile_relations(tables, rules)
    plans = [(partial(evaluate_domain, tables, d), d.figures) for d in domains]
    plans += [
        (partial(evaluate_order, tables, name, order), [Figure(name, order.later, "date_order", "", "")])
        for name, order in orders
    ]

    def write(plan: Callable[[], DataFrame], target: str) -> None:
        _told(plan()).write.mode("overwrite").parquet(target)

    targets = [f"{results}/source=relation_{i}" for i in range(len(plans))]
    jobs = {at: (partial(write, plan, at), figures) for at, (plan, figures) in zip(targets, plans)}
    return jobs, skipped


def stored_run(spark: SparkSession, paths: Mapping[str, str]) -> DataFrame:
    """All results of one run, with its errors, as the run left them by check."""
    return spark.read.schema(RESULT).option("header", True).csv(paths["by_check"], enforceSchema=False)


def stored_results(spark: SparkSession, out: str) -> DataFrame:
    """The results of all runs below ``out``, with their run."""
    folder = f"{out.rstrip('/')}/results"
    try:
        found = spark.read.schema(f"{RESULT}, run_id string, source string").parquet(folder)
    except PySparkException as error:
        if not is_missing(error):
            raise
        return spark.createDataFrame([], f"{RESULT}, run_id string")
    return found.drop("source")


def expected(history: DataFrame) -> DataFrame:
    """The volume of each run against stored runs of its weekday; runs without a date in their id have none."""
    date = F.expr("try_to_date(substring(run_id, 1, 8), 'yyyyMMdd')")
    counts = history.where("check_type = 'volume' AND actual IS NOT NULL").select(
        "table_name", "run_id", date.alias("run_date"), F.col("actual").cast("bigint").alias("record_count")
    )
    return expected_volumes(counts.where("run_date IS NOT NULL"))


def alerts(history: DataFrame, run_id: str, settings: RunSettings) -> DataFrame:
    """Alerts of a run: ``(run_id, alert, table_name, check_type, value, limit)``."""
    checks = rollup_checks(history)
    share = failed_share_alert(checks, settings.failed_checks_pct).where(
        F.col("alert") & (F.col("run_id") == run_id)
    )
    series = consecutive_failures(checks, settings.consecutive_failures).where(F.col("last_run") == run_id)
    none = F.lit(None).cast("string")
    return share.select(
        "run_id",
        F.lit("failed_checks").alias("alert"),
        none.alias("table_name"),
        none.alias("check_type"),
        F.col("failed_pct").alias("value"),
        F.lit(settings.failed_checks_pct).alias("limit"),
    ).unionByName(
        series.select(
            F.col("last_run").alias("run_id"),
            F.lit("consecutive_failures").alias("alert"),
            "table_name",
            "check_type",
            F.col("failures").cast("double").alias("value"),
            F.lit(float(settings.consecutive_failures)).alias("limit"),
        )
    )


def drop_old_runs(spark: SparkSession, out: str, as_of: str, days: int, dry_run: bool = True) -> DataFrame:
    """Runs below ``out`` whose date lies more than ``days`` before ``as_of``: ``(path, dropped)``.

    A run is a folder ``run_id=yyyymmdd_hhmmss`` below any of the parts. Nothing is deleted unless
    ``dry_run`` is off. The driver reads folder names only.
    """
    first = datetime.date.fromisoformat(as_of) - datetime.timedelta(days=days)
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    pattern = hadoop(f"{out.rstrip('/')}/*/run_id=*")
    files = pattern.getFileSystem(spark._jsc.hadoopConfiguration())
    old = []
    for status in files.globStatus(pattern) or ():
        day = re.fullmatch(r"run_id=(\d{4})(\d{2})(\d{2})_\d{6}", status.getPath().getName())
        if day and datetime.date(*map(int, day.groups())) < first:
            dropped = not dry_run and files.delete(status.getPath(), True)
            old.append((status.getPath().toString(), dropped))
    schema = "path string, dropped boolean"
    return literal_rows(spark, old, schema) if old else spark.createDataFrame([], schema)


def _results(spark: SparkSession, stored: list[str], broken: list[tuple]) -> DataFrame:
    results = spark.createDataFrame([], RESULT)
    if stored:
        results = spark.read.schema(RESULT).parquet(*stored)
    if broken:
        results = results.unionByName(literal_rows(spark, broken, RESULT))
    return results
