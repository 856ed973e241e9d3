"""Configured rules on newly arrived data.

Every rule is a buffer that can be merged: a count is added up, a time stamp is the greatest of its
parts, uniqueness is an HLL sketch of the keys. A micro-batch stores one row of buffers per day of its
rows, and a day is judged from the rows of all batches, so its verdict does not depend on how the rows
were spread over batches. A batch writes into folders of its own and overwrites them: a batch repeated
after a failure counts once.

A day is final once the latest time stamp of any earlier batch lies ``delay_hours`` behind its end. Rows that
arrive for a final day are late: they are stored aside, whole, and do not change its verdict. Rows without a
time stamp belong to a day of their own, which is never final.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import partial

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions import text
from plumbline.functions.frames import NothingToDo, union_all
from plumbline.functions.jobs import side_by_side
from plumbline.functions.schema import resolve
from plumbline.operators.checks import literal_rows
from plumbline.operators.table_checks import timestamp_column
from plumbline.plans.policy import TableRules
from plumbline.plans.rules import Check, compile_checks
from plumbline.sources import load_table
from plumbline.streaming.monitor import arrivals

DELAY_HOURS = 24.0
#: Registers of a sketch are two to this power; its relative standard error is 1.04 over their root.
SKETCH_BITS = 12
STANDARD_ERROR = 1.04 / 2 ** (SKETCH_BITS / 2)


def key_columns(df: DataFrame, rule: TableRules) -> list[str]:
    """The columns of the key, or none where the table lacks one of them."""
    found = [resolve(df, c) for c in rule.primary_key]
    return [] if None in found else found


def day_column(df: DataFrame, rule: TableRules) -> str:
    column = resolve(df, rule.timestamp_column) if rule.timestamp_column else timestamp_column(df)
    if column is None:
        raise NothingToDo("no time stamp to tell days by")
    return column


def _stamp(df: DataFrame, column: str) -> str:
    cell = text.name(column)
    return f"try_to_timestamp({cell})" if isinstance(df.schema[column].dataType, T.StringType) else cell


def schema_of(checks: list[Check]) -> str:
    figures = ", ".join(f"{text.name(c.key)}: bigint" for c in checks)
    return (
        "day date, late boolean, total_rows bigint, latest timestamp, "
        f"figures struct<{figures or '`none`: bigint'}>, keys binary"
    )


def buffers(df: DataFrame, rule: TableRules, final_until: str | None = None) -> DataFrame:
    """A row of buffers per day, and one more for rows of days that were final: days that end at
    ``final_until`` or before."""
    stamp = _stamp(df, day_column(df, rule))
    checks = compile_checks(df, rule, None)
    figures = ", ".join(f"{text.literal(c.key)}, {c.aggregate}" for c in checks) or "'none', 0L"
    key = ", ".join(map(text.name, key_columns(df, rule)))
    sketch = f"hll_sketch_agg(xxhash64({key}), {SKETCH_BITS})" if key else "CAST(any_value(NULL) AS BINARY)"
    ended = f"to_date({stamp}) + INTERVAL 1 DAY <= TIMESTAMP {text.literal(final_until)}" if final_until else "false"
    return df.groupBy(F.expr(f"to_date({stamp}) AS day"), F.expr(f"coalesce({ended}, false) AS late")).agg(
        F.expr("count(1) AS total_rows"),
        F.expr(f"CAST(max({stamp}) AS TIMESTAMP) AS latest"),
        F.expr(f"named_struct({figures}) AS figures"),
        F.expr(f"{sketch} AS keys"),
    )


def stored_buffers(spark: SparkSession, out: str, checks: list[Check]) -> DataFrame:
    """The buffers of all batches; rules that a batch did not know yet are null in its rows."""
    schema = f"{schema_of(checks)}, batch bigint"
    try:
        return spark.read.schema(schema).parquet(f"{out}/buffers")
    except AnalysisException:  # nothing has arrived yet
        return spark.createDataFrame([], schema)


def judged(stored: DataFrame, table: str, checks: list[Check], delay_hours: float = DELAY_HOURS) -> DataFrame:
    """Verdicts per day and rule: ``(day, table_name, column_name, check_type, status, threshold, actual,
    final, late_rows)``."""
    parts = ", ".join(
        f"{text.literal(c.key)}, {c.merge}(CASE WHEN NOT late THEN figures.{text.name(c.key)} END)" for c in checks
    )
    days = stored.groupBy("day").agg(
        F.expr("coalesce(sum(CASE WHEN NOT late THEN total_rows END), 0L) AS total_rows"),
        F.expr("coalesce(sum(CASE WHEN late THEN total_rows END), 0L) AS late_rows"),
        F.expr(f"named_struct({parts or repr('none') + ', 0L'}) AS figures"),
        F.expr("nullif(hll_sketch_estimate(hll_union_agg(CASE WHEN NOT late THEN keys END)), 0) AS found_keys"),
    )
    latest = stored.agg(F.max("latest")).scalar()
    days = days.withColumn("latest", latest)
    rows = [c.result(f"figures.{text.name(c.key)}") for c in checks]
    rows.append(_uniqueness())
    ended = f"day + INTERVAL 1 DAY + INTERVAL {int(delay_hours * 3600)} SECOND <= latest"
    return days.selectExpr(
        "day",
        f"{text.literal(table)} AS table_name",
        f"coalesce({ended}, false) AS final",
        "late_rows",
        f"inline({text.structs(rows)})",
    ).where("check_type <> 'primary_key' OR actual IS NOT NULL")


def _uniqueness() -> dict[str, str]:
    """Repeated keys are told from the error of the sketch above three standard errors."""
    repeated = "CASE WHEN found_keys > 0 THEN greatest(0D, try_divide(total_rows - found_keys, total_rows) * 100) END"
    limit = round(300 * STANDARD_ERROR, 2)
    return {
        "column_name": "CAST(NULL AS STRING)",
        "check_type": "'primary_key'",
        "status": f"CASE WHEN ({repeated}) <= {limit} THEN 'PASS' ELSE 'FAIL' END",
        "threshold": text.literal(f"<={limit:g}% repeated, estimated"),
        "actual": f"CAST({repeated} AS DOUBLE)",
    }


def take_in(stream: DataFrame, rule: TableRules, out: str, checkpoint: str, delay_hours: float = DELAY_HOURS) -> None:
    """Store the buffers of all that has arrived since the last call, batch by batch."""
    spark = stream.sparkSession
    checks = compile_checks(stream, rule, None)
    stamp = _stamp(stream, day_column(stream, rule))

    def store(batch: DataFrame, batch_id: int) -> None:
        earlier = stored_buffers(spark, out, checks).where(F.col("batch") < batch_id)
        final_until = earlier.agg(
            F.expr(f"date_format(max(latest) - INTERVAL {int(delay_hours * 3600)} SECOND, 'yyyy-MM-dd HH:mm:ss')")
        ).first()[0]
        found = buffers(batch, rule, final_until)
        # A row or two per day of the batch.
        found.repartition(1).write.mode("overwrite").parquet(f"{out}/buffers/batch={batch_id}")
        own = stored_buffers(spark, out, checks).where(F.col("batch") == batch_id)
        if not own.where("late").isEmpty():
            late = batch.where(f"to_date({stamp}) + INTERVAL 1 DAY <= TIMESTAMP {text.literal(final_until)}")
            late.write.mode("overwrite").parquet(f"{out}/late/batch={batch_id}")

    query = (
        stream.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


RESULT = (
    "day date, table_name string, final boolean, late_rows bigint, column_name string, check_type string, "
    "status string, threshold string, actual double"
)


def watch(
    spark: SparkSession,
    refs: Mapping[str, str],
    rules: Mapping[str, TableRules],
    out: str,
    delay_hours: float = DELAY_HOURS,
    files_a_batch: int | None = None,
) -> DataFrame:
    """Take in what has arrived for every table that has rules, and judge all days seen so far.

    Everything is kept below ``out``, a folder per table. A table that cannot be read or judged is one
    ERROR row; the others go on.
    """
    names = [name for name in refs if name in rules]
    found: dict[str, DataFrame] = {}

    def run(name: str) -> None:
        folder, rule = f"{out.rstrip('/')}/{name}", rules[name]
        schema = load_table(spark, refs[name]).schema
        reader = spark.readStream.schema(schema)
        if files_a_batch:
            reader = reader.option("maxFilesPerTrigger", files_a_batch)
        stream = arrivals(reader, refs[name])
        take_in(stream, rule, folder, f"{folder}/checkpoint", delay_hours)
        checks = compile_checks(stream, rule, None)
        found[name] = judged(stored_buffers(spark, folder, checks), name, checks, delay_hours)

    errors = side_by_side({name: partial(run, name) for name in names})
    parts = [found[name].select(*[c.split()[0] for c in RESULT.split(", ")]) for name in names if name not in errors]
    if errors:
        rows = [(None, name, False, 0, None, "evaluation", "ERROR", e, None) for name, e in errors.items()]
        parts.append(literal_rows(spark, rows, RESULT))
    return union_all(parts)
