"""The daily run: snapshot, profile, findings, score and reports."""

from __future__ import annotations

import time
from collections.abc import Iterable, Mapping, Sequence
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.functions.jobs import FAILURES, bisected, error_name, side_by_side
from plumbline.functions.schema import column_specs
from plumbline.functions.text import name as quoted
from plumbline.operators import checks, frequency, profile, report, scoring, sketches, snapshot
from plumbline.operators.drift import drift_between, drift_consecutive
from plumbline.plans.policy import Policy
from plumbline.sources import read_documents, write_csv, write_documents, write_lines


def assess(
    tables: Mapping[str, DataFrame],
    policy: Policy = Policy(),
    distinct: str = "exact",
    max_columns: int | None = None,
    stats: Iterable[str] = profile.ALL_STATS,
) -> DataFrame:
    """Profile, findings and score of every column of every table, as one plan."""
    profiled = profile.profile_tables(
        dict(tables), distinct=distinct, max_columns=max_columns, stats=stats
    )
    return scoring.score_alerts(checks.with_findings(profiled, policy))


def take_snapshots(
    sources: Mapping[str, DataFrame],
    keys: Mapping[str, str | list[str]],
    run_date: str,
    run_id: str,
    rates: Mapping[str, float] | None = None,
    as_of: str | None = None,
) -> dict[str, DataFrame]:
    """A reproducible sample of each source with the ingest columns of the run."""
    usual = snapshot.run_fraction(run_date)
    taken = {}
    for name, df in sources.items():
        rate = usual if rates is None else rates.get(name, usual)
        sampled = snapshot.hash_sample(df, keys[name], run_date, rate)
        taken[f"{name}_daily"] = snapshot.stamp_run(sampled, run_date, run_id, as_of)
    return taken


def run_daily(
    tables: Mapping[str, DataFrame],
    out: str,
    run_id: str,
    generated_at: str,
    policy: Policy = Policy(),
    distinct: str = "exact",
    max_columns: int | None = None,
    failed: Mapping[str, str] | None = None,
    seed: int | None = None,
    run_date: str | None = None,
    keep_sketches: bool = False,
) -> dict[str, str]:
    """Assess the tables and write document, detail, findings, summary and metrics below ``out``.

    Each table is profiled once and its assessment stored; all reports read what was stored. A column
    that cannot be analysed is found by halving its table's columns and becomes an ERROR row; the other columns
    are assessed without it. So does a table that cannot be read at all; ``failed`` names those that
    could not even be loaded, with their errors. ``keep_sketches`` stores sketches of the assessed columns beside the
    run, at the cost of one more scan, for :func:`window_profile`.
    """
    started = time.monotonic()
    failed = dict(failed or {})
    if not tables:
        raise RuntimeError(f"no table could be loaded: {failed}")
    spark = next(iter(tables.values())).sparkSession
    paths = {
        part: f"{out.rstrip('/')}/{part}/run_id={run_id}"
        for part in ("assessment", "documents", "detail", "findings", "summary", "metrics", "sketches")
    }
    targets = {name: f"{paths['assessment']}/source={name}" for name in tables}

    good: dict[str, str] = {}
    broken: dict[tuple[str, str], str] = {}

    def store(name: str) -> None:
        df = tables[name]
        columns = [spec.name for spec in column_specs(df, max_columns=max_columns)]
        numbers = {column: i for i, column in enumerate(columns)}

        def store_columns(part: Sequence[str]) -> None:
            chosen = df if len(part) == len(columns) else df.select(*map(quoted, part))
            assessed = assess({name: chosen}, policy, distinct, max_columns, profile.WITHOUT_SPREAD)
            if len(part) < len(columns):
                place = F.create_map(*[F.lit(x) for c in part for x in (c, numbers[c])])
                assessed = assessed.withColumn("ordinal", place[F.col("column_name")].cast("int"))
            assessed.write.mode("append" if name in good else "overwrite").parquet(targets[name])
            good[name] = targets[name]

        try:
            store_columns(columns)
        except FAILURES as error:
            # A table that cannot even be counted has no column to blame.
            df.select(F.lit(1)).groupBy().count().first()
            half = max(1, len(columns) // 2)
            errors = {}
            for part in (columns[:half], columns[half:]):
                errors |= bisected(store_columns, part)[1] if part else {}
            if name in good:
                broken.update({(name, column): error for column, error in errors.items()})
            else:
                # A table of ingest columns only has none to blame either.
                broken[name, ""] = next(iter(errors.values()), error_name(error))

    failed |= side_by_side({name: partial(store, name) for name in tables})
    if not good:
        raise RuntimeError(f"no table could be analysed: {failed or broken}")
    stored = spark.read.parquet(*[good[name] for name in tables if name in good])
    if keep_sketches:
        failed |= side_by_side({name: partial(_sketch, tables[name], name, broken, paths["sketches"]) for name in good})
    errors = [(name, None, error) for name, error in failed.items()]
    errors += [(name, column or None, error) for (name, column), error in sorted(broken.items())]
    detail = report.report_detail(stored, policy=policy)
    totals = report.table_results(stored)
    found = stored.select("table_name", "column_name", F.inline("findings"))
    if errors:
        failures = checks.literal_rows(spark, errors, "table_name string, column_name string, message string")
        detail = report.with_error_rows(detail, failures)
        whole = failures.where("column_name IS NULL").select("table_name")
        totals = totals.unionByName(whole, allowMissingColumns=True)
        evaluated = failures.selectExpr(
            "table_name", "column_name", "'check' AS record", "'evaluation' AS check_type", "'ERROR' AS status", "message"
        )
        known = [c for c in evaluated.columns if c in found.columns]
        found = found.unionByName(evaluated.select(*known), allowMissingColumns=True)
    lines = report.summary_lines(totals, "DAILY DATA QUALITY ANALYSIS", run_id, generated_at, run_date, seed)
    metrics = report.run_metrics(stored, time.monotonic() - started)
    unwritten = side_by_side(
        {
            "documents": lambda: write_documents(
                report.run_document(stored, run_id, generated_at), paths["documents"]
            ),
            "detail": lambda: write_csv(detail, paths["detail"]),
            "findings": lambda: found.write.mode("overwrite").parquet(paths["findings"]),
            "summary": lambda: write_lines(lines, paths["summary"]),
            "metrics": lambda: write_documents(metrics, paths["metrics"]),
        }
    )
    if unwritten:
        raise RuntimeError(f"reports could not be written: {unwritten}")
    return paths


def _sketch(df: DataFrame, name: str, broken: Mapping[tuple[str, str], str], out: str) -> None:
    known = df.drop(*[column for table, column in broken if table == name])
    sketches.column_sketches(known, name).write.mode("overwrite").parquet(f"{out}/source={name}")


def window_profile(spark, out: str, first_run: str = "", last_run: str = "~") -> DataFrame:
    """Counts, estimated distinct counts and quantiles per column over the runs from ``first_run`` to ``last_run``,
    from the sketches that the runs kept: no table is read again."""
    stored = spark.read.option("basePath", f"{out.rstrip('/')}/sketches").parquet(f"{out.rstrip('/')}/sketches/run_id=*")
    runs = F.col("run_id").cast("string").between(first_run, last_run)
    return sketches.estimated(sketches.merged(stored.where(runs), "table_name"))


def batch_drift(spark, out: str) -> DataFrame:
    """Drift between consecutive runs whose documents ``run_daily`` left below ``out``."""
    pattern = f"{out.rstrip('/')}/documents/run_id=*/*.json"
    documents = read_documents(spark, pattern, report.DOCUMENT_SCHEMA)
    runs = documents.select("run_id").distinct()
    return drift_consecutive(report.document_stats(documents), runs)


def pair_drift(spark, out: str, old_run: str, new_run: str) -> DataFrame:
    """Drift between two chosen runs below ``out``."""
    pattern = f"{out.rstrip('/')}/documents/run_id=*/*.json"
    documents = read_documents(spark, pattern, report.DOCUMENT_SCHEMA)
    return drift_between(report.document_stats(documents), old_run, new_run)


def detail_with_values(
    tables: Mapping[str, DataFrame], policy: Policy = Policy(), distinct: str = "exact"
) -> DataFrame:
    """The column detail with the frequent values of string columns."""
    # No report shows the deviation, which would read the counted values once more.
    profiled = profile.profile_tables(tables, distinct=distinct, stats=profile.WITHOUT_SPREAD)
    scored = scoring.score_signs(profiled, policy)
    values = frequency.frequent_values(tables, report.SHOWN_VALUES, share=False)
    return report.report_detail(scored, values, policy)
