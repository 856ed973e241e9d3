"""Column expressions shared by the operators. All are Spark built-ins, so they stay in codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def percent(part: Column, whole: Column) -> Column:
    """100 * part / whole, and 0 where the whole is 0 (division by zero raises in ANSI mode)."""
    return F.coalesce(F.try_divide(part, whole) * 100, F.lit(0.0))


def half_up(value: Column | str, digits: int) -> Column:
    """Round half up. The noise of floating point goes first: 3.125 may come as 3.12499999999."""
    return F.round(F.round(value, 9), digits)


def age_hours(latest: Column, as_of: Column) -> Column:
    """Hours between two timestamps, with microsecond precision."""
    micros = F.unix_micros(as_of.cast("timestamp")) - F.unix_micros(latest.cast("timestamp"))
    return micros / F.lit(3.6e9)


def grouped_number(value: Column) -> Column:
    """Whole number with thousands separators."""
    return F.format_number(value, 0)


def _hash_prefix(*parts: Column) -> Column:
    text = F.concat_ws("|", *[p.cast("string") for p in parts])
    return F.substring(F.md5(text), 1, 8)


def hash_unit(*parts: Column) -> Column:
    """Deterministic number in [0, 1) from the md5 of the key parts."""
    return F.conv(_hash_prefix(*parts), 16, 10).cast("double") / F.lit(4294967296.0)


def in_hash_sample(fraction: float, *parts: Column) -> Column:
    """True for the share ``fraction`` of keys.

    The choice depends on the key alone, so it is the same for any partitioning, any retry of a
    lost task and any engine with md5.
    """
    if fraction >= 1.0:
        return F.lit(True)
    bound = f"{max(int(fraction * 4294967296), 0):08x}"
    return _hash_prefix(*parts) < F.lit(bound)
