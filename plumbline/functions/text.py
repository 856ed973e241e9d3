"""Expressions as SQL text. A plan over hundreds of columns is built from a few long texts, since
each Column object made in Python costs a call into the JVM."""

from __future__ import annotations


def name(column: str) -> str:
    """A column name, quoted."""
    return "`" + column.replace("`", "``") + "`"


def literal(value: str | int | float | bool | None) -> str:
    """A Python value as a SQL literal."""
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, int):
        return str(value)
    if isinstance(value, float):
        return f"CAST('{value!r}' AS DOUBLE)"
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


NO_TEXT = "CAST(NULL AS STRING)"

# Texts longer than this are grouped by digest, so that a shuffle carries 65 characters instead.
DIGEST_ABOVE = 64


def digest(cell: str) -> str:
    """A short text as it is, a long one by digest; the mark keeps digests and texts apart."""
    return f"CASE WHEN length({cell}) > {DIGEST_ABOVE} THEN concat('#', sha2({cell}, 256)) ELSE {cell} END"


def percent(part: str, whole: str) -> str:
    """100 * part / whole, and 0 where the whole is 0."""
    return f"coalesce(try_divide({part}, {whole}) * 100, 0D)"


def half_up(value: str, digits: int) -> str:
    """Round half up, past the noise of floating point."""
    return f"round(round({value}, 9), {digits})"


def structs(rows: list[dict[str, str]]) -> str:
    """An array of structs, from rows of ``field: expression``."""
    texts = (
        "named_struct(" + ", ".join(f"{literal(f)}, {e}" for f, e in row.items()) + ")" for row in rows
    )
    return "array(" + ", ".join(texts) + ")"
