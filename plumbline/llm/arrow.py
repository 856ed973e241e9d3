"""Helpers of the operators that work on Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that a worker takes out of an Arrow batch at a time.
SLICE = 1 << 22


def octets(column: pa.Array) -> list[bytes | None]:
    """The texts of a column in UTF-8."""
    return column.cast(pa.binary()).to_pylist()


class Memo(dict):
    """Results of a function of short keys; it forgets everything when it is full."""

    def __init__(self, function: Callable, entries: int = 1 << 19):
        super().__init__()
        self.function, self.entries = function, entries

    def __missing__(self, key):
        if len(self) >= self.entries:
            self.clear()
        value = self[key] = self.function(key)
        return value


def chunks(sizes: list[int] | np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of neighbouring rows whose sizes add up to about ``most``; a larger row is alone."""
    start, total = 0, 0
    for i, size in enumerate(sizes):
        if total and total + size > most:
            yield start, i
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield start, len(sizes)


def sliced(batches: Iterator[pa.RecordBatch], text: int, most: int = SLICE) -> Iterator[pa.RecordBatch]:
    """All rows of all batches in order, in slices whose texts add up to about ``most`` bytes: what a worker makes
    of them, and keeps of its heap after that, follows the slice and not the batch. ``text`` is the column's number;
    a batch without rows stays."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        for a, b in chunks(sizes.tolist(), most) if len(sizes) else [(0, 0)]:
            yield batch.slice(a, b - a)
