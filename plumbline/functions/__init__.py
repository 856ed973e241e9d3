from plumbline.functions.scalars import (
    age_hours,
    grouped_number,
    half_up,
    hash_unit,
    in_hash_sample,
    percent,
)
from plumbline.functions.schema import ColumnSpec, METADATA_COLUMNS, business_columns, column_specs

__all__ = [
    "ColumnSpec",
    "METADATA_COLUMNS",
    "age_hours",
    "business_columns",
    "column_specs",
    "grouped_number",
    "half_up",
    "hash_unit",
    "in_hash_sample",
    "percent",
]
