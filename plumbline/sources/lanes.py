"""CSV with a lane for broken lines, and types from one pass over the values.

Lines that do not have the columns of the header are kept aside with their file and text. Each other value
tells, as a bit mask, which types it could be; the masks of a column are combined by ``bit_and``, and
the narrowest type that is left is the column's. Values that share none are texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.functions import text

CORRUPT, FILE = "_corrupt_record", "_file"
# From narrow to wide where one holds the values of the other; a mask has a bit for each.
TYPES = ("int", "bigint", "double", "date", "timestamp", "boolean")
_NUMBER = "^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"
_DAY = "^[0-9]{4}-[0-9]{2}-[0-9]{2}"
# What each type looks like; the cast tells whether it is one.
_LOOKS = {
    "int": "^[+-]?[0-9]+$",
    "bigint": "^[+-]?[0-9]+$",
    "double": f"{_NUMBER}|^-?(NaN|Infinity|Inf)$",
    "date": f"{_DAY}$",
    "timestamp": f"{_DAY}([T ][0-9]{{1,2}}:[0-9]{{1,2}}(:[0-9]{{1,2}}([.][0-9]{{1,6}})?)?(Z|[+-][0-9]{{2}}:?[0-9]{{2}})?)?$",
    "boolean": "^(?i:true|false)$",
}


def mask(cell: str) -> str:
    """SQL for the types that a text could be, as bits; null for a missing one."""
    bits = (
        f"CASE WHEN {cell} RLIKE {text.literal(look)} AND try_cast({cell} AS {kind}) IS NOT NULL THEN {1 << i} ELSE 0 END"
        for i, (kind, look) in enumerate(_LOOKS.items())
    )
    return f"CASE WHEN {cell} IS NOT NULL THEN {' | '.join(bits)} END"


def _raw(spark: SparkSession, path: str) -> DataFrame:
    """All lines but headers and blank ones, parsed as texts, with the whole line where it is broken.

    The lines are parsed by an expression: the reader's own lane for broken lines depends on the columns that a
    query asks for. A line that repeats the header is a header; as by the reader's default, a line is a row.
    """
    names = spark.read.csv(path, header=True).columns
    lines = spark.read.text(path).where("trim(value) <> ''").select("value", F.col("_metadata.file_path").alias(FILE))
    head = lines.first()
    schema = ", ".join(f"{text.name(n)} STRING" for n in [*names, CORRUPT])
    options = f"map('mode', 'PERMISSIVE', 'columnNameOfCorruptRecord', '{CORRUPT}')"
    parsed = F.expr(f"from_csv(value, {text.literal(schema)}, {options})").alias("parsed")
    rows = lines if head is None else lines.where(F.col("value") != head["value"])
    return rows.select(FILE, parsed).select("parsed.*", FILE)


def inferred_types(raw: DataFrame) -> dict[str, str]:
    """The narrowest type of each column; a column without values, or of several kinds, is text."""
    names = [c for c in raw.columns if c not in (CORRUPT, FILE)]
    masks = [F.expr(f"bit_and({mask(text.name(c))})").alias(f"m{i}") for i, c in enumerate(names)]
    found = raw.where(F.col(CORRUPT).isNull()).agg(*masks).first()
    result = {}
    for name, bits in zip(names, found):
        kinds = [kind for i, kind in enumerate(TYPES) if (bits or 0) >> i & 1]
        result[name] = kinds[0] if kinds else "string"
    return result


def read_lanes(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """The rows of a CSV with a header, typed, and its broken lines as ``(file, record, n_values)``."""
    raw = _raw(spark, path)
    types = inferred_types(raw)
    good = raw.where(F.col(CORRUPT).isNull()).select(
        *[F.expr(f"CAST({text.name(c)} AS {kind})").alias(c) for c, kind in types.items()]
    )
    values = F.size(F.array_compact(F.array(*map(text.name, types))))
    broken = raw.where(F.col(CORRUPT).isNotNull()).select(
        F.col(FILE).alias("file"), F.col(CORRUPT).alias("record"), values.alias("n_values")
    )
    return good, broken
