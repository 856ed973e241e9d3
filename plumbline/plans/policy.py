"""Which columns a rule concerns and which limits it uses."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Policy:
    """Name patterns and limits of the column rules.

    The patterns are regular expressions on the column name; the default ones are those of the
    loan tables the rules were made for.
    """

    id_pattern: str = r"^SK_ID_"
    binary_pattern: str = r"^TARGET$"
    non_positive_pattern: str = r"DAYS_"
    non_negative_pattern: str = r"AMT_"
    amount_pattern: str = r"^(AMT_|CNT_)"
    null_critical_pct: float = 95.0
    null_warning_pct: float = 50.0
    null_info_pct: float = 20.0
    null_fail_pct: float = 50.0
    id_uniqueness_pct: float = 95.0
    long_string: int = 100
    outlier_deviations: float = 3.0


@dataclass(frozen=True)
class Range:
    low: float
    high: float


# Limits that apply where a configuration names none.
DEFAULT_VOLUME = Range(100, 1_000_000)
CRITICAL_NULL_PCT = 5.0
WATCHED_NULL_PCT = 20.0
RANGE_TOLERANCE_PCT = 5.0
FRESHNESS_HOURS = 24.0
FAILED_CHECKS_PCT = 25.0
CONSECUTIVE_FAILURES = 3
RETENTION_DAYS = 30
# Points of score that a run may lie off, and that may gather, before a table's score has changed.
CHANGE_SLACK, CHANGE_LIMIT = 0.5, 4.0
# Spreads by which a volume may lie off that of earlier runs, and how many runs of a weekday there must be.
VOLUME_DEVIATIONS, VOLUME_LEAST_RUNS = 5.0, 3


@dataclass(frozen=True)
class RunSettings:
    """When a run raises an alert, and how long its results are kept."""

    failed_checks_pct: float = FAILED_CHECKS_PCT
    consecutive_failures: int = CONSECUTIVE_FAILURES
    retention_days: int = RETENTION_DAYS


@dataclass(frozen=True)
class Reference:
    """A column whose values another table must hold, as a foreign key or as a lookup."""

    column: str
    parent: str
    key: str
    check_type: str = "foreign_key"


@dataclass(frozen=True)
class Sequence:
    """Whole numbers without gaps, within each value of ``group``."""

    position: str
    group: str | None = None


@dataclass(frozen=True)
class DateOrder:
    """A date that must not lie before one of the parent row; ``spread_by`` salts large keys."""

    later: str
    parent: str
    earlier: str
    on: tuple[str, str]
    spread_by: tuple[str, ...] = ()


@dataclass(frozen=True)
class TableRules:
    """Rules of one table, as a configuration names them."""

    volume: Range | None = None
    critical: tuple[str, ...] = ()
    max_null_pct: float = CRITICAL_NULL_PCT
    watched: tuple[str, ...] = ()
    max_watched_null_pct: float = WATCHED_NULL_PCT
    ranges: dict[str, Range] = field(default_factory=dict)
    range_tolerance_pct: float = RANGE_TOLERANCE_PCT
    patterns: dict[str, str] = field(default_factory=dict)
    pattern_tolerance_pct: float = 0.0
    # Columns of texts that must be readable as a type.
    types: dict[str, str] = field(default_factory=dict)
    primary_key: tuple[str, ...] = ()
    references: tuple[Reference, ...] = ()
    sequences: tuple[Sequence, ...] = ()
    date_orders: tuple[DateOrder, ...] = ()
    # None checks no freshness. Without a column the first one of a timestamp type is taken.
    freshness_hours: float | None = FRESHNESS_HOURS
    timestamp_column: str | None = None
    no_timestamp_status: str = "SKIP"
    no_value_status: str = "SKIP"
    # The column rules hold for all tables of a configuration that have the column.
    general: bool = False

    @property
    def relations(self) -> bool:
        """Whether any rule is about more than one row."""
        return bool(self.primary_key or self.references or self.sequences or self.date_orders)


# Bounds of the loan columns.
LOAN_RANGES = {
    "AMT_INCOME_TOTAL": Range(0, 10_000_000),
    "AMT_CREDIT": Range(0, 5_000_000),
    "AMT_ANNUITY": Range(0, 1_000_000),
    "AMT_GOODS_PRICE": Range(0, 5_000_000),
    "DAYS_BIRTH": Range(-25_000, -6_000),
    "DAYS_EMPLOYED": Range(-20_000, 1),
    "CNT_CHILDREN": Range(0, 20),
}

# Row limits of the daily loan tables.
LOAN_VOLUMES = {
    "application_train_daily": Range(1_000, 50_000),
    "application_test_daily": Range(500, 25_000),
    "bureau_daily": Range(2_000, 100_000),
    "bureau_balance_daily": Range(10_000, 500_000),
    "credit_card_balance_daily": Range(2_000, 100_000),
    "installments_payments_daily": Range(10_000, 200_000),
    "POS_CASH_balance_daily": Range(5_000, 150_000),
    "previous_application_daily": Range(5_000, 100_000),
}

# Columns of the daily loan tables that must not be null.
LOAN_CRITICAL = {
    "application_train_daily": ("SK_ID_CURR", "TARGET"),
    "application_test_daily": ("SK_ID_CURR",),
    "bureau_daily": ("SK_ID_CURR", "SK_ID_BUREAU"),
    "bureau_balance_daily": ("SK_ID_BUREAU",),
    "credit_card_balance_daily": ("SK_ID_CURR", "SK_ID_PREV"),
    "installments_payments_daily": ("SK_ID_CURR", "SK_ID_PREV"),
    "POS_CASH_balance_daily": ("SK_ID_CURR", "SK_ID_PREV"),
    "previous_application_daily": ("SK_ID_CURR", "SK_ID_PREV"),
}

# Further columns whose nulls are watched where a table has them.
LOAN_WATCHED = ("AMT_INCOME_TOTAL", "AMT_CREDIT", "AMT_ANNUITY", "AMT_GOODS_PRICE")

# The shorter lists of the strict rule set.
LOAN_STRICT_CRITICAL = {
    "application_train_daily": ("SK_ID_CURR", "AMT_INCOME_TOTAL"),
    "application_test_daily": ("SK_ID_CURR",),
    "bureau_daily": ("SK_ID_CURR", "SK_ID_BUREAU"),
    "bureau_balance_daily": ("SK_ID_BUREAU",),
    "credit_card_balance_daily": ("SK_ID_PREV",),
    "installments_payments_daily": ("SK_ID_PREV",),
    "POS_CASH_balance_daily": ("SK_ID_PREV",),
    "previous_application_daily": ("SK_ID_PREV",),
}
LOAN_STRICT_RANGES = {
    "application_train_daily": ("AMT_INCOME_TOTAL", "AMT_CREDIT"),
    "application_test_daily": ("AMT_INCOME_TOTAL", "AMT_CREDIT"),
    "previous_application_daily": ("AMT_CREDIT",),
}


def loan_rules() -> dict[str, TableRules]:
    """The tolerant rule set: some nulls and some values out of range are let through."""
    return {
        table: TableRules(
            volume=volume,
            critical=LOAN_CRITICAL[table],
            watched=LOAN_WATCHED,
            ranges=LOAN_RANGES,
            timestamp_column="ingestion_timestamp",
        )
        for table, volume in LOAN_VOLUMES.items()
    }


def strict_loan_rules() -> dict[str, TableRules]:
    """The strict rule set: no value out of range, and a table without time stamps counts as fresh."""
    return {
        table: TableRules(
            volume=volume,
            critical=LOAN_STRICT_CRITICAL[table],
            ranges={c: LOAN_RANGES[c] for c in LOAN_STRICT_RANGES.get(table, ())},
            range_tolerance_pct=0.0,
            no_timestamp_status="PASS",
            no_value_status="FAIL",
        )
        for table, volume in LOAN_VOLUMES.items()
    }
