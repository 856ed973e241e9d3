"""What the profile needs to know about a schema."""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# The columns a snapshot adds to the business columns.
METADATA_COLUMNS = (
    "ingestion_date",
    "ingestion_timestamp",
    "simulation_id",
    "data_source",
    "batch_id",
    "random_seed",
)

NUMERIC = "numeric"
STRING = "string"
OTHER = "other"
# Types without equality, by their name or that of a part.
UNCOUNTABLE = r"map<|variant"


@dataclass(frozen=True)
class ColumnSpec:
    """One profiled column: its place, its type and how it is treated."""

    ordinal: int
    name: str
    data_type: T.DataType
    kind: str
    nullable: bool

    @property
    def type_name(self) -> str:
        return self.data_type.simpleString()

    @property
    def countable(self) -> bool:
        """Whether distinct values can be counted; maps and variants have no equality."""
        return not re.search(UNCOUNTABLE, self.type_name)


def kind_of(data_type: T.DataType) -> str:
    if isinstance(data_type, T.NumericType):
        return NUMERIC
    if isinstance(data_type, (T.StringType, T.CharType, T.VarcharType)):
        return STRING
    return OTHER


def business_columns(df: DataFrame, metadata: Iterable[str] = METADATA_COLUMNS) -> DataFrame:
    """The table without the columns a snapshot added."""
    return df.drop(*metadata)


def column_specs(
    df: DataFrame,
    *,
    skip: Iterable[str] = METADATA_COLUMNS,
    max_columns: int | None = None,
) -> list[ColumnSpec]:
    """Columns to profile, in schema order; ``max_columns`` keeps the first few."""
    dropped = set(skip)
    fields = [f for f in df.schema.fields if f.name not in dropped]
    return [
        ColumnSpec(i, f.name, f.dataType, kind_of(f.dataType), f.nullable)
        for i, f in enumerate(fields[:max_columns])
    ]


def resolve(df: DataFrame, column: str) -> str | None:
    """The column that the session finds under a name, if the table has one."""
    if df.sparkSession.conf.get("spark.sql.caseSensitive").lower() == "true":
        return column if column in df.columns else None
    return next((c for c in df.columns if c.lower() == column.lower()), None)
