"""Command line: ``python -m plumbline daily|snapshot|check|monitor|drift|retain|export …``."""

from __future__ import annotations

import argparse
import datetime

from pyspark.sql import SparkSession

from plumbline.operators.rollup import ERROR_FIRST, FAIL_FIRST
from plumbline.operators.snapshot import JITTER_WIDTHS, run_seed, snapshot_summary
from plumbline.plans.checking import drop_old_runs, run_checks
from plumbline.plans.daily import batch_drift, pair_drift, run_daily, take_snapshots
from plumbline.plans.policy import RETENTION_DAYS, Policy
from plumbline.plans.rules import parse_rules, parse_settings, parse_sources, read_config
from plumbline.plans.simulate import write_snapshots
from plumbline.sources import export_tables, load_each, write_documents
from plumbline.streaming.watch import DELAY_HOURS, watch


def _named(pairs: list[str]) -> dict[str, str]:
    return dict(pair.split("=", 1) for pair in pairs)


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="plumbline", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)
    daily = commands.add_parser("daily", help="snapshot the tables and assess every column")
    daily.add_argument("tables", nargs="+", metavar="name=path")
    daily.add_argument("--out", required=True)
    daily.add_argument("--key", nargs="*", default=[], metavar="name=column,…", help="sample by this key")
    daily.add_argument("--date", default=datetime.date.today().isoformat())
    daily.add_argument("--distinct", choices=["exact", "approx", "none"], default="exact")
    daily.add_argument("--max-columns", type=int)
    daily.add_argument("--sketches", action="store_true", help="keep sketches, so that runs can be profiled together")
    daily.add_argument("--policy", help="JSON file with name patterns and limits; loan tables if left out")
    taken = commands.add_parser("snapshot", help="store a sample of each table by day")
    taken.add_argument("tables", nargs="+", metavar="name=path")
    taken.add_argument("--out", required=True)
    taken.add_argument("--key", nargs="+", required=True, metavar="name=column,…")
    taken.add_argument("--rate", nargs="*", default=[], metavar="name=share")
    taken.add_argument("--jitter", nargs="*", default=[], metavar="name=family")
    taken.add_argument("--date", default=datetime.date.today().isoformat())
    taken.add_argument("--days", type=int, help="store this many days before the date instead")
    check = commands.add_parser("check", help="evaluate the rules of a configuration")
    check.add_argument("tables", nargs="*", metavar="name=path", help="beside, or instead of, the paths in the rules")
    check.add_argument("--rules", required=True, help="JSON file")
    check.add_argument("--out", required=True)
    check.add_argument("--as-of", help="time that freshness is measured from; now if left out")
    check.add_argument("--split-rows", action="store_true", help="store accepted and rejected rows apart")
    check.add_argument("--error-first", action="store_true", help="an error outranks a failure")
    monitor = commands.add_parser("monitor", help="judge what has arrived since the last call by the rules, day by day")
    monitor.add_argument("tables", nargs="*", metavar="name=path", help="beside, or instead of, the paths in the rules")
    monitor.add_argument("--rules", required=True, help="JSON file")
    monitor.add_argument("--out", required=True)
    monitor.add_argument("--delay-hours", type=float, default=DELAY_HOURS, help="after which a day is final")
    drift = commands.add_parser("drift", help="compare consecutive runs below a folder")
    drift.add_argument("--out", required=True)
    drift.add_argument("--runs", nargs=2, metavar=("old", "new"), help="compare these two instead")
    retain = commands.add_parser("retain", help="list runs that are older than the limit")
    retain.add_argument("--out", required=True)
    limit = retain.add_mutually_exclusive_group()
    limit.add_argument("--days", type=int, help=f"{RETENTION_DAYS} if neither this nor the rules say")
    limit.add_argument("--rules", help="JSON file that names the days of retention")
    retain.add_argument("--date", default=datetime.date.today().isoformat())
    retain.add_argument("--drop", action="store_true", help="delete them")
    export = commands.add_parser("export", help="copy tables to Parquet")
    export.add_argument("tables", nargs="+", metavar="name=path")
    export.add_argument("--out", required=True)
    options = parser.parse_args(arguments)

    spark = SparkSession.builder.appName(f"plumbline-{options.command}").getOrCreate()
    now = datetime.datetime.now()
    if options.command == "daily":
        tables, failed = load_each(spark, _named(options.tables))
        keys = {name: key.split(",") for name, key in _named(options.key).items()}
        run_id = f"{options.date.replace('-', '')}_{now:%H%M%S}"
        sampled = {name: df for name, df in tables.items() if name in keys}
        whole = {name: df for name, df in tables.items() if name not in keys}
        snapshots = take_snapshots(sampled, keys, options.date, run_id)
        paths = run_daily(
            {**whole, **snapshots},
            options.out,
            run_id,
            now.isoformat(timespec="seconds"),
            Policy(**read_config(spark, options.policy)) if options.policy else Policy(),
            options.distinct,
            options.max_columns,
            failed,
            run_seed(options.date),
            options.date,
            options.sketches,
        )
        print("\n".join(f"{part}: {path}" for part, path in paths.items()))
    elif options.command == "snapshot":
        results = write_snapshots(
            spark,
            _named(options.tables),
            {name: key.split(",") for name, key in _named(options.key).items()},
            options.date,
            options.out,
            {name: float(rate) for name, rate in _named(options.rate).items()},
            {name: JITTER_WIDTHS[family] for name, family in _named(options.jitter).items()},
            days=options.days,
        )
        results.show(truncate=False)
        snapshot_summary(results).show(truncate=False)
    elif options.command == "check":
        config = read_config(spark, options.rules)
        paths = run_checks(
            spark,
            parse_sources(config) | _named(options.tables),
            parse_rules(config),
            options.out,
            f"{now:%Y%m%d_%H%M%S}",
            options.as_of or now.isoformat(sep=" ", timespec="seconds"),
            ERROR_FIRST if options.error_first else FAIL_FIRST,
            parse_settings(config),
            options.split_rows,
        )
        print("\n".join(f"{part}: {path}" for part, path in paths.items()))
    elif options.command == "monitor":
        config = read_config(spark, options.rules)
        refs = parse_sources(config) | _named(options.tables)
        days = watch(spark, refs, parse_rules(config), options.out, options.delay_hours)
        target = f"{options.out.rstrip('/')}/verdicts/run_id={now:%Y%m%d_%H%M%S_%f}"
        write_documents(days, target)
        print(f"verdicts: {target}")
    elif options.command == "drift":
        target = f"{options.out.rstrip('/')}/drift/{now:%Y%m%d_%H%M%S}"
        chosen = pair_drift(spark, options.out, *options.runs) if options.runs else batch_drift(spark, options.out)
        write_documents(chosen, target)
        print(f"drift: {target}")
    elif options.command == "retain":
        days = RETENTION_DAYS if options.days is None else options.days
        if options.rules:
            days = parse_settings(read_config(spark, options.rules)).retention_days
        old = drop_old_runs(spark, options.out, options.date, days, dry_run=not options.drop)
        old.show(1000, truncate=False)
    else:
        export_tables(spark, _named(options.tables), options.out).show(truncate=False)


if __name__ == "__main__":
    main()
