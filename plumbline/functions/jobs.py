"""Spark jobs that do not depend on each other."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException

from plumbline.functions.frames import NothingToDo

# What a table that cannot be read or analysed raises; a broken file is raised by the JVM as it is.
FAILURES = (PySparkException, Py4JJavaError, NothingToDo)
_SEVERAL = "STAGE_MATERIALIZATION_MULTIPLE_FAILURES"
_MISSING = ("PATH_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND")


def is_missing(error: Exception) -> bool:
    """Whether the error says that there is no such table or path."""
    return isinstance(error, PySparkException) and (error.getCondition() or "").startswith(_MISSING)


def error_name(error: Exception) -> str:
    """The condition that Spark names, or else the kind of error.

    Where several stages of a job fail at once, it is the condition of the first failure.
    """
    condition = error.getCondition() if isinstance(error, PySparkException) else None
    if condition and condition != _SEVERAL:
        return condition
    named = [n for n in re.findall(r"\[([A-Z][A-Z0-9_.]{3,})\]", str(error)) if n != _SEVERAL]
    return named[0] if named else condition or type(error).__name__


def side_by_side(jobs: Mapping[str, Callable[[], object]], at_once: int = 8) -> dict[str, str]:
    """Run independent jobs at the same time, so that one fills the executors another leaves idle.

    Gives the error of each job that failed in Spark; the other jobs go on.
    """

    def attempt(job: Callable[[], object]) -> str | None:
        try:
            job()
        except FAILURES as error:
            return error_name(error)
        return None

    with ThreadPoolExecutor(max_workers=at_once) as pool:
        results = dict(zip(jobs, pool.map(attempt, jobs.values())))
    return {name: error for name, error in results.items() if error is not None}


def bisected(job: Callable[[Sequence], object], parts: Sequence) -> tuple[list, dict]:
    """Run a job over parts; where it fails, run it over each half, until what fails stands alone.

    Gives the results of the groups that succeeded, in order, and the error of each part that failed. Without
    a failure the job runs once; ``k`` failing parts of ``n`` cost about ``2 * k * log2(n)`` runs.
    """
    try:
        return [job(parts)], {}
    except FAILURES as error:
        if len(parts) < 2:
            return [], {part: error_name(error) for part in parts}
    half = len(parts) // 2
    first, errors = bisected(job, parts[:half])
    rest, more = bisected(job, parts[half:])
    return first + rest, errors | more
