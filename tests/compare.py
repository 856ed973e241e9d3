"""Compare the queries with their SQL in DuckDB: ``python tests/compare.py [sf_dir] [name …]``."""

from __future__ import annotations

import datetime
import decimal
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from plumbline.queries import ORACLES, QUERIES
from plumbline.queries.inputs import TABLES


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return connection


def plain(value):
    if isinstance(value, decimal.Decimal):
        return ("decimal", str(value))
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def kind(values) -> str:
    found = {type(v).__name__ for v in values if v is not None}
    return "/".join(sorted(found)) or "null"


def sorted_rows(rows):
    return sorted(rows, key=lambda row: tuple((v is None, type(v).__name__, str(v)) for v in row))


def difference(spark, connection, name: str, sf_dir: str) -> str | None:
    """What differs between the query and its SQL, or nothing."""
    df = QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    got = [tuple(plain(v) for v in row) for row in df.select(*columns).collect()]
    result = connection.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    if sorted(names) != columns:
        return f"columns {columns} != {sorted(names)}"
    order = [names.index(c) for c in columns]
    want = [tuple(plain(row[i]) for i in order) for row in result.fetchall()]
    if len(got) != len(want):
        return f"{len(got)} rows, expected {len(want)}"
    for i, column in enumerate(columns):
        a, b = kind(r[i] for r in got), kind(r[i] for r in want)
        if a != b:
            return f"type of {column}: {a} != {b}"
    for a, b in zip(sorted_rows(got), sorted_rows(want)):
        if a != b:
            return f"row\n   {dict(zip(columns, a))}\n   {dict(zip(columns, b))}"
    return None


def main() -> None:
    from pyspark.sql import SparkSession

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:] or list(QUERIES)
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = duck(sf_dir)
    bad = 0
    for name in wanted:
        started = time.monotonic()
        try:
            if name in ORACLES:
                problem = difference(spark, connection, name, sf_dir)
            else:
                problem = None if QUERIES[name](spark, sf_dir).count() > 0 else "no rows"
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{name}: {problem or 'ok'} ({time.monotonic() - started:.1f} s)", flush=True)
    print(f"{len(wanted) - bad} of {len(wanted)} agree")


if __name__ == "__main__":
    main()
