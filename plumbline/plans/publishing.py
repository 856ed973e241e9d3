"""Accepting and rejecting rows as a run: write, audit, publish.

1. One scan writes accepted and rejected rows side by side into a folder of the attempt. ``reasons`` is a
   bit mask: bit ``i`` stands for a null in the ``i``-th critical column, 0 is an accepted row. The same job
   counts what it reads.
2. The counts of what was written are read back and held against what was read.
3. Only then a manifest, one small file that is created or not there, names the attempt. Readers see a day
   through its manifest alone, so what a failed or repeated attempt left is never seen, and a day that is published
   is not written again.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from plumbline.functions.text import name as quoted

ACCEPTED, REJECTED = "accepted", "rejected"
#: Columns that a mask of 64 bits has room for, its sign left alone.
MOST_COLUMNS = 62


class AuditFailed(RuntimeError):
    """What was written is not what was read; nothing has been published."""


def reasons(critical: Iterable[str]) -> Column:
    """A bit for each critical column that is null."""
    columns = list(critical)
    if len(columns) > MOST_COLUMNS:
        raise ValueError(f"a mask has room for {MOST_COLUMNS} columns")
    bits = [F.when(F.col(quoted(c)).isNull(), F.lit(1 << i)).otherwise(F.lit(0)) for i, c in enumerate(columns)]
    mask = F.lit(0)
    for bit in bits:
        mask = mask.bitwiseOR(bit)
    return mask.cast("bigint")


def publish(df: DataFrame, critical: Iterable[str], out: str, day: str) -> dict:
    """Write, audit and publish a day of a table; gives its manifest. A published day is left as it is."""
    spark, columns = df.sparkSession, list(critical)
    known = read_manifest(spark, out, day)
    if known is not None:
        return known
    attempt = f"{out.rstrip('/')}/data/day={day}/attempt-{uuid.uuid4().hex}"
    written = _write(df, columns, attempt)
    manifest = {"day": day, "path": attempt, "columns": columns, **_audit(spark, attempt, written)}
    return _publish(spark, out, day, manifest)


def _write(df: DataFrame, columns: list[str], attempt: str) -> int:
    """One scan for both halves; the number of rows that were read."""
    seen = Observation()
    verdict = F.when(F.col("reasons") == 0, ACCEPTED).otherwise(REJECTED)
    marked = df.observe(seen, F.count(F.lit(1)).alias("rows")).withColumn("reasons", reasons(columns))
    marked.withColumn("verdict", verdict).write.partitionBy("verdict").parquet(attempt)
    return seen.get["rows"]


def _audit(spark: SparkSession, attempt: str, read: int) -> dict[str, int]:
    """Rows of both halves as they were written; they must add up to what was read."""
    counts = {ACCEPTED: 0, REJECTED: 0}
    if read:
        found = spark.read.parquet(attempt).groupBy("verdict").agg(F.count(F.lit(1)).alias("n")).collect()
        counts |= {row["verdict"]: row["n"] for row in found}
    if sum(counts.values()) != read:
        raise AuditFailed(f"{read} rows were read, {counts} were written below {attempt}")
    return counts


def _manifest_path(spark: SparkSession, out: str, day: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{out.rstrip('/')}/manifests/{day}.json")
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def _publish(spark: SparkSession, out: str, day: str, manifest: dict) -> dict:
    """Create the manifest. If another attempt was first, its manifest stands."""
    path, files = _manifest_path(spark, out, day)
    draft = spark._jvm.org.apache.hadoop.fs.Path(f"{out.rstrip('/')}/drafts/{uuid.uuid4().hex}.json")
    stream = files.create(draft, False)
    stream.write(bytearray(json.dumps(manifest).encode()))
    stream.close()
    files.mkdirs(path.getParent())
    # Whole or not at all: a file is never renamed onto one that is there.
    try:
        moved = not files.exists(path) and files.rename(draft, path)
    except Py4JJavaError:
        moved = False
    if not moved:
        files.delete(draft, False)
    return read_manifest(spark, out, day) or manifest


def read_manifest(spark: SparkSession, out: str, day: str) -> dict | None:
    """The manifest of a published day."""
    path, files = _manifest_path(spark, out, day)
    if not files.exists(path):
        return None
    return json.loads(spark.read.text(path.toString(), wholetext=True).first()[0])


def published(spark: SparkSession, out: str, day: str, verdict: str = ACCEPTED) -> DataFrame | None:
    """Accepted or rejected rows of a published day; rejected ones keep ``reasons``. None where the day is
    not published, or where it has no such row."""
    manifest = read_manifest(spark, out, day)
    if manifest is None or not manifest[verdict]:
        return None
    rows = spark.read.parquet(f"{manifest['path']}/verdict={verdict}")
    return rows.drop("reasons") if verdict == ACCEPTED else rows


def rejected_by(rejected: DataFrame, columns: list[str]) -> DataFrame:
    """Rejected rows by reason: the columns that were null, and how many rows had them all."""
    names = F.array_compact(
        F.array(*[F.when(F.col("reasons").bitwiseAND(F.lit(1 << i)) != 0, F.lit(c)) for i, c in enumerate(columns)])
    )
    counted = rejected.groupBy("reasons").agg(F.count(F.lit(1)).alias("row_count"))
    return counted.select("reasons", F.array_join(names, ", ").alias("null_columns"), "row_count")
