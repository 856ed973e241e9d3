"""Rules over a column profile: alerts, checks and the findings they give.

Every rule is a condition on one profile row, so all rules of a run are one projection of the
profile; severity and status are columns of their own and never read back out of a message.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.functions import text
from plumbline.functions.scalars import grouped_number
from plumbline.functions.schema import NUMERIC, STRING, UNCOUNTABLE
from plumbline.plans.policy import (
    CRITICAL_NULL_PCT,
    DEFAULT_VOLUME,
    WATCHED_NULL_PCT,
    Policy,
    Range,
)

ALERT, CHECK = "alert", "check"
PASS, FAIL, ERROR, SKIP = "PASS", "FAIL", "ERROR", "SKIP"

FINDING = (
    "struct<record:string,check_type:string,severity:string,status:string,"
    "threshold:string,actual:double,message:string>"
)


@dataclass(frozen=True)
class Rule:
    """A finding that a profile row gives when the condition holds; conditions are SQL text."""

    record: str
    check_type: str
    applies: str
    message: str
    severity: str | None = None
    status: str | None = None
    threshold: str | None = None
    actual: str = "NULL"

    def finding(self) -> str:
        values = ", ".join(
            (
                text.literal(self.record),
                text.literal(self.check_type),
                text.literal(self.severity),
                self.status or "NULL",
                text.literal(self.threshold),
                self.actual,
                self.message,
            )
        )
        return f"CASE WHEN {self.applies} THEN CAST(struct({values}) AS {FINDING}) END"


def _pass_if(condition: str) -> str:
    return f"CASE WHEN {condition} THEN '{PASS}' ELSE '{FAIL}' END"


def _shown(template: str, *figures: str) -> str:
    """A message with figures of two digits."""
    return f"format_string('{template}', {', '.join(text.half_up(f, 2) for f in figures)})"


def column_rules(policy: Policy) -> list[Rule]:
    """The alerts and checks of a column, in the order they are reported."""

    def named(pattern: str) -> str:
        return f"column_name RLIKE {text.literal(pattern)}"

    p = policy
    has_rows = "total_rows > 0"
    numeric = f"kind = '{NUMERIC}' AND non_null_count > 0"
    string = f"kind = '{STRING}' AND non_null_count > 0"
    is_id = f"{named(p.id_pattern)} AND uniqueness_pct IS NOT NULL"
    bands = [
        ("CRITICAL", f"null_pct > {p.null_critical_pct}", "data integrity issue"),
        (
            "WARNING",
            f"null_pct > {p.null_warning_pct} AND null_pct <= {p.null_critical_pct}",
            "high null rate",
        ),
        (
            "INFO",
            f"null_pct > {p.null_info_pct} AND null_pct <= {p.null_warning_pct}",
            "moderate null rate",
        ),
    ]
    return [
        Rule(ALERT, "empty_table", "total_rows = 0", "'No data found'", "CRITICAL", actual="0"),
        *[
            Rule(
                ALERT,
                "null_band",
                f"{has_rows} AND {band}",
                _shown(f"%.2f%% null values - {words}", "null_pct"),
                severity,
                actual="null_pct",
            )
            for severity, band, words in bands
        ],
        Rule(
            CHECK,
            "null_validation",
            has_rows,
            _shown("%.2f%% null values", "null_pct"),
            status=_pass_if(f"null_pct <= {p.null_fail_pct}"),
            threshold=f"<={p.null_fail_pct:g}%",
            actual="null_pct",
        ),
        Rule(
            ALERT,
            "distinctness",
            f"data_type RLIKE {text.literal(UNCOUNTABLE)} AND non_null_count > 0",
            "'Could not calculate distinctness'",
            "INFO",
        ),
        Rule(
            ALERT,
            "id_uniqueness",
            f"{is_id} AND uniqueness_pct < {p.id_uniqueness_pct}",
            _shown("ID column uniqueness only %.2f%%", "uniqueness_pct"),
            "WARNING",
            actual="uniqueness_pct",
        ),
        Rule(
            CHECK,
            "id_uniqueness",
            is_id,
            _shown("%.2f%% unique", "uniqueness_pct"),
            status=_pass_if(f"uniqueness_pct >= {p.id_uniqueness_pct}"),
            threshold=f">={p.id_uniqueness_pct:g}%",
            actual="uniqueness_pct",
        ),
        Rule(
            ALERT,
            "binary_domain",
            f"{numeric} AND {named(p.binary_pattern)} AND (min_num < 0 OR max_num > 1)",
            _shown("values outside [0,1]: %.2f to %.2f", "min_num", "max_num"),
            "ERROR",
            actual="CASE WHEN max_num > 1 THEN max_num ELSE min_num END",
        ),
        Rule(
            ALERT,
            "non_positive",
            f"{numeric} AND {named(p.non_positive_pattern)} AND max_num > 0",
            _shown("positive values: max=%.2f", "max_num"),
            "WARNING",
            actual="max_num",
        ),
        Rule(
            ALERT,
            "non_negative",
            f"{numeric} AND {named(p.non_negative_pattern)} AND min_num < 0",
            _shown("negative amounts: min=%.2f", "min_num"),
            "WARNING",
            actual="min_num",
        ),
        Rule(
            ALERT,
            "constant",
            f"{numeric} AND range_span = 0",
            _shown("constant value: %.2f", "min_num"),
            "INFO",
            actual="min_num",
        ),
        Rule(
            CHECK,
            "numeric_range_validation",
            numeric,
            _shown("%.2f to %.2f, mean %.2f", "min_num", "max_num", "mean"),
            status=f"'{PASS}'",
            actual="range_span",
        ),
        Rule(
            ALERT,
            "empty_string",
            f"{string} AND min_len = 0",
            "'contains empty strings'",
            "WARNING",
            actual="min_len",
        ),
        Rule(
            ALERT,
            "long_string",
            f"{string} AND max_len > {p.long_string}",
            "format_string('very long strings (max: %d)', max_len)",
            "INFO",
            actual="max_len",
        ),
        Rule(
            CHECK,
            "string_length_validation",
            string,
            "format_string('%d to %d characters', min_len, max_len)",
            status=f"'{PASS}'",
            actual="max_len",
        ),
    ]


def _findings_text(rules: Iterable[Rule]) -> str:
    return "filter(array(" + ", ".join(r.finding() for r in rules) + "), f -> f IS NOT NULL)"


def _run_key(df: DataFrame) -> list[str]:
    return ["run_id"] if "run_id" in df.columns else []


def column_findings(
    profile: DataFrame, policy: Policy = Policy(), only: Iterable[str] | None = None
) -> DataFrame:
    """Alerts and checks as rows; ``only`` keeps some check types."""
    wanted = None if only is None else set(only)
    rules = [r for r in column_rules(policy) if wanted is None or r.check_type in wanted]
    return profile.selectExpr(
        *_run_key(profile), "table_name", "column_name", f"inline({_findings_text(rules)})"
    )


def with_findings(profile: DataFrame, policy: Policy = Policy()) -> DataFrame:
    """The profile with its findings as one array per column, and their counts."""
    found = profile.withColumn("findings", F.expr(_findings_text(column_rules(policy))))
    return found.selectExpr(
        "*",
        "size(filter(findings, f -> f.severity = 'CRITICAL')) AS critical_alerts",
        "size(filter(findings, f -> f.severity = 'WARNING')) AS warning_alerts",
        f"size(filter(findings, f -> f.status = '{FAIL}')) AS failed_checks",
    )


def alert_class(severity: Column) -> Column:
    """How an alert is shown: critical, warning, or info for everything else."""
    return (
        F.when(severity == "CRITICAL", "critical").when(severity == "WARNING", "warning").otherwise("info")
    )


# --- rules by table and column ---------------------------------------------------------------


def null_limits(
    spark: SparkSession,
    critical: Mapping[str, Iterable[str]],
    watched: Mapping[str, Iterable[str]] | None = None,
) -> DataFrame:
    """Null limits as rows: 5 % for critical columns, 20 % for the other watched ones."""
    rows = [(t, c, CRITICAL_NULL_PCT, True) for t, names in critical.items() for c in names]
    known = {(t, c) for t, c, _, _ in rows}
    rows += [
        (t, c, WATCHED_NULL_PCT, False)
        for t, names in (watched or {}).items()
        for c in names
        if (t, c) not in known
    ]
    return literal_rows(
        spark, rows, "table_name string, column_name string, limit_pct double, is_critical boolean"
    )


def literal_rows(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A few configured rows as a table inside the plan."""
    names = [part.split()[0] for part in schema.split(",")]
    kind = "array<struct<" + ",".join(":".join(p.split(None, 1)) for p in schema.split(",")) + ">>"
    values = text.structs([{n: text.literal(v) for n, v in zip(names, row)} for row in rows])
    return spark.range(1).selectExpr(f"inline(CAST({values} AS {kind}))")


def null_limit_checks(profile: DataFrame, limits: DataFrame) -> DataFrame:
    """Null share against the limit of each configured column; absent columns are left out."""
    return profile.join(limits, ["table_name", "column_name"]).select(
        *_run_key(profile),
        "table_name",
        "column_name",
        F.lit("null_checks").alias("check_type"),
        "null_count",
        "total_rows",
        "null_pct",
        "limit_pct",
        "is_critical",
        F.expr(_pass_if("null_pct <= limit_pct")).alias("status"),
    )


def volume_checks(
    counts: DataFrame,
    limits: Mapping[str, Range],
    default: Range = DEFAULT_VOLUME,
    name_limits: bool = False,
) -> DataFrame:
    """Row counts against the inclusive limits of each table.

    The message of a failure tells on which side it lies, or with ``name_limits`` both limits.
    """
    low, high = F.lit(int(default.low)), F.lit(int(default.high))
    for table, limit in limits.items():
        low = F.when(F.col("table_name") == table, int(limit.low)).otherwise(low)
        high = F.when(F.col("table_name") == table, int(limit.high)).otherwise(high)
    n, lo, hi = F.col("record_count"), F.col("min_threshold"), F.col("max_threshold")
    below = F.concat(
        F.lit("Record count "), grouped_number(n), F.lit(" below minimum "), grouped_number(lo)
    )
    above = F.concat(
        F.lit("Record count "), grouped_number(n), F.lit(" above maximum "), grouped_number(hi)
    )
    if name_limits:
        below = above = F.concat(
            F.lit("Record count "),
            grouped_number(n),
            F.lit(" outside range ("),
            grouped_number(lo),
            F.lit("-"),
            grouped_number(hi),
            F.lit(")"),
        )
    within = F.concat(F.lit("Record count "), grouped_number(n), F.lit(" within acceptable range"))
    return counts.withColumns(
        {"min_threshold": low.cast("bigint"), "max_threshold": high.cast("bigint")}
    ).select(
        *_run_key(counts),
        "table_name",
        F.lit("volume").alias("check_type"),
        "record_count",
        "min_threshold",
        "max_threshold",
        F.expr(_pass_if("record_count BETWEEN min_threshold AND max_threshold")).alias("status"),
        F.when(n < lo, below).when(n > hi, above).otherwise(within).alias("message"),
    )


def volume_change_checks(counts: DataFrame, expected: str = "expected_count") -> DataFrame:
    """No rows is CRITICAL, less than half of the expected rows WARNING."""
    n = F.col("record_count")
    return counts.select(
        *_run_key(counts),
        "table_name",
        F.lit("volume_change").alias("check_type"),
        "record_count",
        expected,
        F.when(n == 0, "CRITICAL")
        .when(n < F.col(expected) * 0.5, "WARNING")
        .otherwise(PASS)
        .alias("status"),
        F.when(n == 0, "Empty dataset detected")
        .when(n < F.col(expected) * 0.5, "Volume below 50% of expected")
        .otherwise("Volume as expected")
        .alias("message"),
    )
