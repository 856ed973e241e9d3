"""Column profiles, frequencies and outliers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from plumbline.functions.frames import union_all
from plumbline.functions import half_up
from plumbline.functions.schema import NUMERIC
from plumbline.operators import frequency, outliers, profile, sketches, table_checks
from plumbline.plans.policy import Range
from plumbline.queries import sql
from plumbline.queries.inputs import POLICY, PROFILED, SCHEMAS, event_runs, source, sources
from plumbline.queries.registry import query, rounded, table
from plumbline.queries.sql import pct, r
from plumbline.sources import work_dir


@query(
    "profile_nulls",
    f"""SELECT table_name, column_name, total_rows, null_count, non_null_count,
          {r("null_pct", 2)} AS null_pct
        FROM ({sql.profile(PROFILED, distinct=False)})""",
)
def profile_nulls(spark, sf_dir):
    found = profile.profile_tables(sources(spark, sf_dir, PROFILED), distinct="none", stats=())
    return rounded(found, 2, "null_pct").select(
        "table_name", "column_name", "total_rows", "null_count", "non_null_count", "null_pct"
    )


@query(
    "profile_distinct",
    f"""SELECT table_name, column_name, total_rows, distinct_count,
          {r("uniqueness_pct", 2)} AS uniqueness_pct
        FROM ({sql.profile(PROFILED)})""",
)
def profile_distinct(spark, sf_dir):
    found = profile.profile_tables(sources(spark, sf_dir, PROFILED), stats=profile.WITHOUT_SPREAD)
    return rounded(found, 2, "uniqueness_pct").select(
        "table_name", "column_name", "total_rows", "distinct_count", "uniqueness_pct"
    )


@query(
    "profile_numeric",
    f"""SELECT table_name, column_name, non_null_count, {r("min_num", 4)} AS min_value,
          {r("max_num", 4)} AS max_value, {r("mean", 2)} AS average_value,
          {r("range_span", 4)} AS range_span, 'PASS' AS status
        FROM ({sql.profile(PROFILED, distinct=False)}) WHERE kind = 'n' AND non_null_count > 0""",
)
def profile_numeric(spark, sf_dir):
    found = profile.profile_tables(sources(spark, sf_dir, PROFILED), distinct="none", stats=["range"])
    return found.where((F.col("kind") == "numeric") & (F.col("non_null_count") > 0)).select(
        "table_name",
        "column_name",
        "non_null_count",
        half_up("min_num", 4).alias("min_value"),
        half_up("max_num", 4).alias("max_value"),
        half_up("mean", 2).alias("average_value"),
        half_up("range_span", 4).alias("range_span"),
        F.lit("PASS").alias("status"),
    )


_SPREAD_SQL = f"""SELECT table_name, column_name, {r("mean", 4)} AS mean, {r("stddev", 4)} AS stddev
        FROM ({sql.profile(PROFILED, distinct=False)}) WHERE kind = 'n'"""


@query("profile_stddev_exact", _SPREAD_SQL)
def profile_stddev_exact(spark, sf_dir):
    """The same figures from counted values; only numbers have them, so only numbers are counted."""
    found = profile.profile_tables(sources(spark, sf_dir, PROFILED), kinds=[NUMERIC])
    return rounded(found, 4, "mean", "stddev").select(
        "table_name", "column_name", "mean", "stddev"
    )


@query("profile_stddev", _SPREAD_SQL)
def profile_stddev(spark, sf_dir):
    found = profile.profile_tables(
        sources(spark, sf_dir, PROFILED), distinct="none", stats=["range", "spread"]
    )
    return rounded(found.where("kind = 'numeric'"), 4, "mean", "stddev").select(
        "table_name", "column_name", "mean", "stddev"
    )


@query(
    "string_lengths",
    f"""SELECT table_name, column_name, min_len AS min_length, max_len AS max_length,
          {r("avg_len", 2)} AS avg_length
        FROM ({sql.profile(PROFILED, distinct=False)}) WHERE kind = 's'""",
)
def string_lengths(spark, sf_dir):
    found = profile.profile_tables(
        sources(spark, sf_dir, PROFILED), distinct="none", stats=["lengths"]
    )
    return found.where("kind = 'string'").select(
        "table_name",
        "column_name",
        F.col("min_len").alias("min_length"),
        F.col("max_len").alias("max_length"),
        half_up("avg_len", 2).alias("avg_length"),
    )


_FIRST = 3


@query(
    "profile_first_columns",
    f"""SELECT table_name, column_name, null_count, distinct_count
        FROM ({sql.profile(["lineitem", "events", "part"])}) WHERE ordinal < {_FIRST}""",
)
def profile_first_columns(spark, sf_dir):
    found = profile.profile_tables(
        sources(spark, sf_dir, ["lineitem", "events", "part"]), max_columns=_FIRST
    )
    return found.select("table_name", "column_name", "null_count", "distinct_count")


@query(
    "profile_by_run",
    f"""SELECT run_id, column_name, total_rows, distinct_count, {r("mean", 2)} AS mean
        FROM ({sql.profile(["events"], by="CAST(CAST(ts AS DATE) AS VARCHAR)")})""",
)
def profile_by_run(spark, sf_dir):
    found = profile.column_profile(event_runs(spark, sf_dir), "events", by="run_id")
    return rounded(found, 2, "mean").select(
        "run_id", "column_name", "total_rows", "distinct_count", "mean"
    )


@query(
    "profile_long",
    "WITH p AS ("
    + sql.profile(["customer", "part"])
    + ") "
    + " UNION ALL ".join(
        f"SELECT table_name, column_name, '{stat}' AS stat, {r(f'CAST({stat} AS DOUBLE)', 2)} AS value "
        f"FROM p WHERE {stat} IS NOT NULL"
        for stat in (
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
    ),
)
def long_profile(spark, sf_dir):
    found = profile.profile_tables(sources(spark, sf_dir, ["customer", "part"]))
    return rounded(profile.profile_long(found), 2, "value")


def _union_counts(rows: list[tuple[str, str, str]], check: str) -> str:
    parts = [
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, count(*) AS total_rows, "
        f"count(*) FILTER ({cond}) AS violations FROM {sql.relation(t)}"
        for t, c, cond in rows
    ]
    return (
        f"SELECT *, {r(pct('violations', 'total_rows'), 2)} AS violation_pct FROM ("
        + " UNION ALL ".join(parts)
        + f") /* {check} */"
    )


_RANGES = {
    "orders": {"o_totalprice": Range(2000, 450000), "o_custkey": Range(0, 1_000_000)},
    "lineitem": {"l_quantity": Range(2, 49), "l_discount": Range(0, 0.09), "l_tax": Range(0, 0.08)},
    "events": {"value": Range(0.05, 200)},
    "customer": {"c_acctbal": Range(0, 9000)},
}


@query(
    "range_violations",
    _union_counts(
        [
            (t, c, f"{c} < {b.low} OR {c} > {b.high}")
            for t, ranges in _RANGES.items()
            for c, b in ranges.items()
        ],
        "range",
    ),
)
def range_violations(spark, sf_dir):
    found = union_all(
        [
            table_checks.range_checks(table(spark, sf_dir, t), t, ranges)
            for t, ranges in _RANGES.items()
        ]
    )
    return rounded(found, 2, "violation_pct").select(
        "table_name", "column_name", "total_rows", "violations", "violation_pct"
    )


_AMOUNTS = {
    "customer": ["c_acctbal"],
    "supplier": ["s_acctbal"],
    "part": ["p_size", "p_retailprice"],
    "lineitem": ["l_quantity", "l_extendedprice"],
}


@query(
    "negative_amounts",
    "SELECT *, CASE WHEN violations > 0 THEN violations || ' negative values' END AS issue FROM ("
    + _union_counts([(t, c, f"{c} < 0") for t, names in _AMOUNTS.items() for c in names], "negative")
    + ")",
)
def negative_amounts(spark, sf_dir):
    found = union_all(
        [
            table_checks.sign_counts(table(spark, sf_dir, t), t, names)
            for t, names in _AMOUNTS.items()
        ]
    )
    issue = F.when(
        F.col("violations") > 0,
        F.concat(F.col("violations").cast("string"), F.lit(" negative values")),
    )
    return (
        rounded(found, 2, "violation_pct")
        .drop("check_type")
        .withColumn("issue", issue)
        .select("table_name", "column_name", "total_rows", "violations", "violation_pct", "issue")
    )


_TEXTS = {
    "patchy_orders": ["o_note", "o_comment", "o_open_status"],
    "documents": ["text", "lang", "source"],
    "pages": ["url", "html"],
    "conversations": ["role", "text"],
}


@query(
    "blank_strings",
    _union_counts([(t, c, f"{c} IN ('', ' ')") for t, names in _TEXTS.items() for c in names], "blank"),
)
def blank_strings(spark, sf_dir):
    found = union_all(
        [
            table_checks.blank_counts(source(spark, sf_dir, t), t, names)
            for t, names in _TEXTS.items()
        ]
    )
    return rounded(found, 2, "violation_pct").drop("check_type")


# The usual threshold, and one that the given data exceed more often.
_DEVIATIONS = POLICY.outlier_deviations
_FEWER_DEVIATIONS = 1.7
_SPREAD_TABLES = ["lineitem", "customer", "part", "events"]


def _outlier_sql(name: str, deviations: float) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{name}' AS table_name, '{c}' AS column_name,
              count(*) FILTER (abs({c} - s.m) > {deviations} * s.sd) AS outlier_count
            FROM {name}, (SELECT avg({c}) AS m, stddev_samp({c}) AS sd FROM {name}) s"""
        for c, _, kind in SCHEMAS[name]
        if kind == "n"
    )


def _outliers(spark, sf_dir, deviations):
    found = [outliers.outlier_counts(table(spark, sf_dir, t), t, deviations) for t in _SPREAD_TABLES]
    return union_all(found).select("table_name", "column_name", "outlier_count")


@query("outliers_3sigma", " UNION ALL ".join(_outlier_sql(t, _DEVIATIONS) for t in _SPREAD_TABLES))
def outliers_by_deviation(spark, sf_dir):
    return _outliers(spark, sf_dir, _DEVIATIONS)


@query("outliers_closer", " UNION ALL ".join(_outlier_sql(t, _FEWER_DEVIATIONS) for t in _SPREAD_TABLES))
def outliers_by_fewer_deviations(spark, sf_dir):
    """The same with another threshold."""
    return _outliers(spark, sf_dir, _FEWER_DEVIATIONS)


@query(
    "zscore_rows",
    f"""SELECT event_id, event_type, value, {r("z", 4)} AS z_score FROM (
          SELECT *, (value - s.m) / s.sd AS z
          FROM events, (SELECT avg(value) AS m, stddev_samp(value) AS sd FROM events) s)
        WHERE abs(z) > 3""",
)
def zscore(spark, sf_dir):
    flagged = outliers.zscore_rows(table(spark, sf_dir, "events"), "value", 3.0)
    return flagged.select("event_id", "event_type", "value", half_up("z_score", 4).alias("z_score"))


_FREQUENT = ["patchy_orders", "lineitem", "part", "events", "labelled_documents"]


def frequency_sql(tables: list[str]) -> str:
    parts = [
        f"""SELECT '{t}' AS table_name, '{c}' AS column_name, {c} AS value, count(*) AS value_count,
              count(*) * 100.0 / (SELECT count(*) FROM {sql.relation(t)}) AS value_pct
            FROM {sql.relation(t)} GROUP BY {c}"""
        for t in tables
        for c, _, kind in SCHEMAS[t]
        if kind == "s"
    ]
    return " UNION ALL ".join(parts)


def _best(spark, sf_dir, k: int, share: bool = False):
    return frequency.frequent_values(sources(spark, sf_dir, _FREQUENT), k, share=share)


@query(
    "value_frequencies",
    f"SELECT table_name, column_name, value, value_count, {r('value_pct', 2)} AS value_pct "
    f"FROM ({frequency_sql(_FREQUENT)})",
)
def frequencies(spark, sf_dir):
    found = frequency.value_frequencies(sources(spark, sf_dir, _FREQUENT))
    return rounded(found, 2, "value_pct")


def top_sql(tables: list[str], k: int) -> str:
    return f"""SELECT * FROM (
        SELECT *, CAST(row_number() OVER (PARTITION BY table_name, column_name
          ORDER BY value_count DESC, CASE WHEN length(value) > 64 THEN '#' || sha256(value) ELSE value END
            ASC NULLS LAST) AS INTEGER) AS position
        FROM ({frequency_sql(tables)})) WHERE position <= {k}"""


@query(
    "top_values_5",
    f"SELECT table_name, column_name, position, value, value_count, {r('value_pct', 2)} AS value_pct "
    f"FROM ({top_sql(_FREQUENT, 5)})",
)
def top_values_5(spark, sf_dir):
    best = _best(spark, sf_dir, 5, share=True)
    return rounded(best, 2, "value_pct").select(
        "table_name", "column_name", "position", "value", "value_count", "value_pct"
    )


@query(
    "top_values_3",
    "SELECT table_name, column_name, position, coalesce(value, 'None') AS value, value_count "
    f"FROM ({top_sql(_FREQUENT, 3)})",
)
def top_values_3(spark, sf_dir):
    best = _best(spark, sf_dir, 3)
    return best.select(
        "table_name",
        "column_name",
        "position",
        frequency.shown_value().alias("value"),
        "value_count",
    )


@query(
    "most_frequent",
    f"SELECT table_name, column_name, value AS most_frequent_value, value_count "
    f"FROM ({top_sql(_FREQUENT, 1)})",
)
def most_frequent(spark, sf_dir):
    best = _best(spark, sf_dir, 1)
    return best.withColumnRenamed("value", "most_frequent_value").select(
        "table_name", "column_name", "most_frequent_value", "value_count"
    )


@query(
    "word_count",
    """SELECT word, count(*) AS occurrences FROM (
         SELECT unnest(string_split_regex(text, '[ \\t\\n\\r\\f]+')) AS word FROM documents)
       WHERE word <> '' GROUP BY word""",
)
def words(spark, sf_dir):
    return frequency.word_count(table(spark, sf_dir, "documents"), "text")


@query(
    "profile_approx",
    # The estimate of each distinct count lies within a tenth of the exact count.
    f"""SELECT table_name, column_name, total_rows, null_count, true AS close_to_exact
        FROM ({sql.profile(["lineitem", "orders"], distinct=False)})""",
)
def profile_approx(spark, sf_dir):
    tables = sources(spark, sf_dir, ["lineitem", "orders"])
    exact = profile.profile_tables(tables, stats=profile.WITHOUT_SPREAD).select(
        "table_name", "column_name", F.col("distinct_count").alias("exact_count")
    )
    estimated = profile.profile_tables(tables, distinct="approx", stats=())
    error = F.abs(F.col("distinct_count") - F.col("exact_count"))
    return estimated.join(exact, ["table_name", "column_name"]).select(
        "table_name",
        "column_name",
        "total_rows",
        "null_count",
        (error <= 0.1 * F.col("exact_count")).alias("close_to_exact"),
    )




@query(
    "sketched_runs",
    """SELECT column_name, total_rows, null_count, exact_distinct, TRUE AS distinct_within, ranks_within FROM (
         SELECT 'event_id' AS column_name, count(*) AS total_rows, count(*) - count(event_id) AS null_count,
           count(DISTINCT event_id) AS exact_distinct, TRUE AS ranks_within FROM events
         UNION ALL SELECT 'user_id', count(*), count(*) - count(user_id), count(DISTINCT user_id), TRUE FROM events
         UNION ALL SELECT 'event_type', count(*), count(*) - count(event_type), count(DISTINCT event_type), NULL FROM events
         UNION ALL SELECT 'value', count(*), count(*) - count(value), count(DISTINCT value), TRUE FROM events
         UNION ALL SELECT 'ts', count(*), count(*) - count(ts), count(DISTINCT ts), NULL FROM events
         UNION ALL SELECT 'props', count(*), count(*) - count(props), count(DISTINCT props), NULL FROM events)""",
)
def sketched_runs(spark, sf_dir):
    """Sketches of each day of events, stored and merged over all days, beside the exact counts: whether
    estimates lie within three standard errors, and quantiles within the error of their rank."""
    events, path = event_runs(spark, sf_dir), work_dir(spark, "sketches")
    sketches.column_sketches(events, "events", by="run_id").write.parquet(path)
    ranks = (0.1, 0.25, 0.5, 0.75, 0.9)
    found = sketches.estimated(sketches.merged(spark.read.parquet(path), "table_name"), ranks)
    names = ["event_id", "user_id", "event_type", "value", "ts", "props"]
    numbers = ["event_id", "user_id", "value"]
    exact = events.agg(*[F.count_distinct(c).alias(c) for c in names]).unpivot([], names, "column_name", "exact_distinct")
    # Five numbers for each of three columns.
    quantiles = {r["column_name"]: r["quantiles"] for r in found.where(F.col("column_name").isin(numbers)).collect()}

    def near_rank(column: str, value: float, rank: float):
        below = F.avg((F.col(column) < value).cast("int")) - rank <= sketches.RANK_ERROR
        return below & (F.avg((F.col(column) <= value).cast("int")) - rank >= -sketches.RANK_ERROR)

    shares = events.agg(
        *[
            reduce(lambda a, b: a & b, [near_rank(c, value, rank) for value, rank in zip(quantiles[c], ranks)]).alias(c)
            for c in numbers
        ]
    ).unpivot([], numbers, "column_name", "ranks_within")
    near = F.abs(F.col("distinct_count") - F.col("exact_distinct")) <= F.greatest(
        F.lit(1.0), 3 * sketches.DISTINCT_ERROR * F.col("exact_distinct")
    )
    return (
        found.join(exact, "column_name")
        .join(shares, "column_name", "left")
        .select("column_name", "total_rows", "null_count", "exact_distinct", near.alias("distinct_within"), "ranks_within")
    )
