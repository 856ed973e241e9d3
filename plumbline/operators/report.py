"""Results arranged as reports: detail rows, run totals, nested documents and summary lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions.scalars import grouped_number, half_up
from plumbline.functions.schema import NUMERIC
from plumbline.operators.frequency import shown_value, top_values
from plumbline.plans.policy import Policy

# How much of a frequent value a report shows.
SHOWN_VALUES, SHOWN_CHARACTERS = 3, 20


def issue_texts(policy: Policy, outliers: bool = False) -> Column:
    """The issues of a column as one text; ``outliers`` says that they were counted."""
    far = F.lit(None).cast("string")
    if outliers:
        far = F.when(
            F.col("outlier_count") > 0,
            F.concat(F.col("outlier_count").cast("string"), F.lit(" potential outliers detected")),
        )
    amount = F.col("column_name").rlike(policy.amount_pattern)
    negative = F.when(
        amount & (F.col("negative_count") > 0),
        F.concat(F.col("negative_count").cast("string"), F.lit(" negative values")),
    )
    blank = F.when(
        F.col("blank_count") > 0,
        F.concat(F.col("blank_count").cast("string"), F.lit(" empty strings")),
    )
    return F.concat_ws("; ", far, negative, blank)


def shown_top_values(frequencies: DataFrame) -> DataFrame:
    """The first values of each column as one text, and the most frequent one.

    ``frequencies`` has all values, or the first ones with their position.
    """
    ranked = "position" in frequencies.columns
    best = frequencies.where(F.col("position") <= SHOWN_VALUES) if ranked else top_values(frequencies, SHOWN_VALUES)
    best = best.withColumn("shown", F.substring(shown_value(), 1, SHOWN_CHARACTERS))
    # At most three rows per column are collected.
    ordered = F.array_sort(F.collect_list(F.struct("position", "shown", "value")))
    return (
        best.groupBy("table_name", "column_name")
        .agg(ordered.alias("best"))
        .select(
            "table_name",
            "column_name",
            F.array_join(F.col("best.shown"), ", ").alias("top_values"),
            F.col("best")[0]["value"].alias("most_frequent_value"),
        )
    )


def report_detail(
    scored: DataFrame, frequencies: DataFrame | None = None, policy: Policy = Policy()
) -> DataFrame:
    """One row per column with figures, score, issues and the range or the frequent values."""
    has_range = F.col("min_num").isNotNull() & F.col("max_num").isNotNull()
    rows = scored
    values = F.lit("")
    frequent = F.lit(None).cast("string")
    if frequencies is not None:
        rows = scored.join(shown_top_values(frequencies), ["table_name", "column_name"], "left")
        values = F.coalesce(F.col("top_values"), F.lit(""))
        frequent = F.col("most_frequent_value")
    return rows.select(
        "table_name",
        "column_name",
        "data_type",
        "total_rows",
        "null_count",
        half_up("null_pct", 2).alias("null_percentage"),
        "distinct_count",
        half_up("uniqueness_pct", 2).alias("unique_percentage"),
        F.col("min_num").alias("min_value"),
        F.col("max_num").alias("max_value"),
        half_up("mean", 2).alias("mean_value"),
        frequent.alias("most_frequent_value"),
        F.when(
            (F.col("kind") == NUMERIC) & has_range,
            F.format_string("%.2f - %.2f", half_up("min_num", 2), half_up("max_num", 2)),
        )
        .otherwise(values)
        .alias("range_or_values"),
        "data_quality_score",
        issue_texts(policy, "outlier_count" in rows.columns).alias("issues"),
    )


def with_error_rows(detail: DataFrame, errors: DataFrame) -> DataFrame:
    """What could not be analysed, with score 0: a column under its name, a whole table as ``ERROR``."""
    rows = errors.select(
        "table_name",
        F.coalesce(F.col("column_name"), F.lit("ERROR")).alias("column_name"),
        F.col("message").alias("issues"),
        F.lit(0.0).alias("data_quality_score"),
    )
    return detail.unionByName(rows, allowMissingColumns=True)


def table_results(profile: DataFrame, all_columns: dict[str, int] | None = None) -> DataFrame:
    """Rows and columns per table, from its profile."""
    keys = ["run_id"] if "run_id" in profile.columns else []
    result = profile.groupBy(*keys, "table_name").agg(
        F.max("total_rows").alias("total_rows"), F.count(F.lit(1)).alias("business_columns")
    )
    if all_columns is None:
        return result
    width = F.lit(None)
    for table, count in all_columns.items():
        width = F.when(F.col("table_name") == table, count).otherwise(width)
    return result.withColumn("total_columns", width.cast("bigint"))


def run_totals(tables: DataFrame) -> DataFrame:
    """Tables, rows and columns of a run; a table that failed counts 0 rows and columns."""
    rows, columns = F.coalesce("total_rows", F.lit(0)), F.coalesce("business_columns", F.lit(0))
    return tables.agg(
        F.count(F.lit(1)).alias("total_tables"),
        F.count("total_rows").alias("successful_tables"),
        F.sum(rows).alias("total_rows"),
        F.sum(columns).alias("total_columns"),
        F.avg(columns).alias("avg_columns_per_table"),
    )


def run_document(assessed: DataFrame, run_id: str, generated_at: str) -> DataFrame:
    """One nested row per table: its columns with figures, findings and score.

    A list holds the columns of one table, so it is as long as the schema is wide.
    """
    column = F.struct(
        "ordinal",
        "column_name",
        "data_type",
        "total_rows",
        "null_count",
        half_up("null_pct", 2).alias("null_percentage"),
        "non_null_count",
        F.struct(
            "distinct_count",
            half_up("uniqueness_pct", 2).alias("uniqueness_percentage"),
            F.col("min_num").alias("min_value"),
            F.col("max_num").alias("max_value"),
            half_up("mean", 2).alias("average_value"),
            "range_span",
            F.col("min_len").alias("min_length"),
            F.col("max_len").alias("max_length"),
            half_up("avg_len", 2).alias("avg_length"),
        ).alias("statistics"),
        F.filter("findings", lambda f: f.record == "check").alias("dq_checks"),
        F.filter("findings", lambda f: f.record == "alert").alias("alerts"),
        "data_quality_score",
    )
    return (
        assessed.groupBy("table_name")
        .agg(
            F.max("total_rows").alias("total_rows"),
            F.count(F.lit(1)).alias("business_columns"),
            F.array_sort(F.collect_list(column)).alias("column_analysis"),
        )
        .select(
            F.lit(run_id).alias("simulation_id"), F.lit(generated_at).alias("analysis_timestamp"), "*"
        )
    )


DOCUMENT_SCHEMA = (
    "simulation_id string, analysis_timestamp string, table_name string, total_rows bigint, "
    "business_columns bigint, column_analysis array<struct<ordinal:int, column_name:string, "
    "data_type:string, total_rows:bigint, null_count:bigint, null_percentage:double, "
    "non_null_count:bigint, statistics:struct<distinct_count:bigint, uniqueness_percentage:double, "
    "min_value:double, max_value:double, average_value:double, range_span:double, min_length:int, "
    "max_length:int, avg_length:double>, data_quality_score:double>>"
)


def document_columns(documents: DataFrame) -> DataFrame:
    """The column rows of stored run documents; tables without an analysis are passed over."""
    return documents.select("run_id", "table_name", F.inline("column_analysis")).select(
        "run_id", "table_name", "*", "statistics.*"
    ).drop("statistics")


def document_stats(documents: DataFrame) -> DataFrame:
    """Every numeric field of stored run documents, in the long form that drift compares."""
    rows = document_columns(documents)
    keys = ["run_id", "table_name", "column_name"]
    stats = [
        f.name
        for f in rows.schema.fields
        if f.name not in (*keys, "data_type", "ordinal")
    ]
    wide = rows.select(*keys, *[F.col(s).cast("double").alias(s) for s in stats])
    return wide.unpivot(keys, stats, "stat", "value").where(F.col("value").isNotNull())


def run_metrics(assessed: DataFrame, elapsed_seconds: float | None = None) -> DataFrame:
    """What a run did: rows, columns, checks and alerts, and how long it took."""
    checks = F.size(F.filter("findings", lambda f: f.record == "check"))
    alerts = F.size(F.filter("findings", lambda f: f.record == "alert"))
    per_table = assessed.groupBy("table_name").agg(
        F.max("total_rows").alias("rows"),
        F.count(F.lit(1)).alias("columns"),
        F.sum(checks).alias("checks"),
        F.sum(alerts).alias("alerts"),
    )
    return per_table.agg(
        F.sum("rows").alias("rows_processed"),
        F.sum("columns").alias("columns_analyzed"),
        F.sum("checks").alias("quality_checks_performed"),
        F.sum("alerts").alias("alerts_generated"),
    ).withColumn("execution_time_seconds", F.lit(elapsed_seconds).cast("double"))


def summary_lines(
    tables: DataFrame,
    title: str,
    run_id: str,
    generated_at: str | None = None,
    run_date: str | None = None,
    seed: int | None = None,
) -> DataFrame:
    """Lines of the text summary: a head with totals, then one line per table.

    The head names when it was generated, the seed and the date of the run where they are given; the seed
    stands behind every table too.
    """
    totals = run_totals(tables)
    counted = F.concat(
        grouped_number(F.col("total_rows")),
        F.lit(" rows, "),
        F.col("business_columns").cast("string"),
        F.lit(" columns" if seed is None else f" columns (seed: {seed})"),
    )
    failed = F.col("total_tables") - F.col("successful_tables")
    lines = [F.lit(title), F.lit("=" * 50)]
    if generated_at is not None:
        lines.append(F.lit(f"Generated: {generated_at}"))
    lines.append(F.lit(f"Simulation ID: {run_id}"))
    if seed is not None:
        lines.append(F.lit(f"Random Seed: {seed}"))
    if run_date is not None:
        lines.append(F.lit(f"Simulation Date: {run_date}"))
    lines += [
        F.concat(F.lit("Total Tables: "), F.col("total_tables").cast("string")),
        F.concat(F.lit("Successful: "), F.col("successful_tables").cast("string")),
        F.concat(F.lit("Failed: "), failed.cast("string")),
        F.concat(F.lit("Total Rows: "), grouped_number(F.col("total_rows"))),
        F.concat(F.lit("Total Business Columns: "), F.col("total_columns").cast("string")),
    ]
    head = totals.select(F.inline(F.array(*[_line(i, line) for i, line in enumerate(lines, 1)])))
    body = tables.select(
        F.lit(len(lines) + 1).alias("line_no"),
        F.concat(F.col("table_name"), F.lit(": "), F.coalesce(counted, F.lit("ERROR"))).alias("line"),
    )
    return head.unionByName(body)


def check_lines(results: DataFrame, statuses: DataFrame, title: str, generated_at: str) -> DataFrame:
    """Lines of the summary of a rule run: a head with the tables by status, and for every table its
    status, then its checks, each with its result and, beneath, its columns.

    ``results`` are rows per check and column, ``statuses`` one per table. All lines are one table of
    results, ordered by table, check and column.
    """
    status = F.col("overall_status")
    head = statuses.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(status == s).alias(s) for s in ("PASS", "FAIL", "ERROR", "SKIPPED")],
    ).select(
        F.inline(
            F.array(
                *[
                    _told(F.lit(""), i, "", line)
                    for i, line in enumerate(
                        [
                            F.lit("=" * 80),
                            F.lit(title),
                            F.lit("=" * 80),
                            F.lit(f"Generated: {generated_at}"),
                            F.concat(F.lit("Tables Processed: "), F.col("n").cast("string")),
                            F.concat(F.lit("Successful: "), F.col("PASS").cast("string")),
                            F.concat(F.lit("Failed: "), F.col("FAIL").cast("string")),
                            F.concat(F.lit("Errors: "), F.col("ERROR").cast("string")),
                            F.concat(F.lit("Skipped: "), F.col("SKIPPED").cast("string")),
                            F.lit("=" * 80),
                        ]
                    )
                ]
            )
        )
    )
    names = statuses.select(
        F.inline(
            F.array(
                _told(F.col("table_name"), 0, "", F.concat(F.lit("TABLE: "), F.col("table_name"))),
                _told(F.col("table_name"), 1, "", F.lit("-" * 60)),
                _told(F.col("table_name"), 2, "", F.concat(F.lit("   Overall Status: "), status)),
            )
        )
    )
    figure = F.format_string("%.2f", half_up("actual", 2))
    shown = F.concat(
        F.when(F.col("column_name").isNull(), F.concat(F.lit("   "), F.col("check_type"))).otherwise(
            F.concat(F.lit("   "), F.col("check_type"), F.lit(" "), F.col("column_name"))
        ),
        F.lit(": "),
        F.col("status"),
        F.when(F.col("actual").isNotNull(), F.concat(F.lit(" - "), figure, F.lit(" against "), F.col("threshold")))
        .when(F.col("threshold").isNotNull(), F.concat(F.lit(" - "), F.col("threshold")))
        .otherwise(F.lit("")),
    )
    by = F.concat(F.col("check_type"), F.lit("/"), F.coalesce(F.col("column_name"), F.lit("")))
    body = results.select(F.inline(F.array(_told(F.col("table_name"), 3, by, shown))))
    # One row per line of a report; ordered as a whole, since a report is one file.
    order = Window.orderBy("part", "place", "within", "line")
    return head.unionByName(names).unionByName(body).select(F.row_number().over(order).alias("line_no"), "line")


def _told(part: Column, place: int, within: Column | str, line: Column) -> Column:
    return F.struct(
        part.alias("part"),
        F.lit(place).alias("place"),
        (within if isinstance(within, Column) else F.lit(within)).alias("within"),
        line.alias("line"),
    )


def _line(number: int, text: Column) -> Column:
    return F.struct(F.lit(number).alias("line_no"), text.alias("line"))
