"""Helpers on whole DataFrames."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame


class NothingToDo(ValueError):
    """There is no column, rule or table to work on."""


def union_all(parts: Iterable[DataFrame]) -> DataFrame:
    """One plan for several inputs, so that their scans run side by side."""
    found = list(parts)
    if not found:
        raise NothingToDo("nothing to combine")
    return reduce(DataFrame.unionByName, found)
