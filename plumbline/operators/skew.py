"""Joins that hold when one key fills a large share of the rows."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.functions.text import name as quoted

# Keys that the sketch for hot keys follows.
TRACKED = 16_384


def hot_keys(df: DataFrame, keys: list[str], share: float) -> DataFrame:
    """Keys with at least ``share`` of all rows. There are at most ``1 / share`` of them.

    A single key is searched by a sketch of fixed size: one more scan, of which a task shuffles one
    row. A key near the limit may be missed or added, which changes the plan of a join, not its rows.
    """
    if len(keys) == 1:
        top = f"approx_top_k({quoted(keys[0])}, {math.ceil(1 / share)}, {TRACKED})"
        found = df.agg(F.expr(f"{top} AS top"), F.count(F.lit(1)).alias("n"))
        items = found.select("n", F.inline("top"))
        return items.where(F.col("count") >= F.col("n") * share).select(F.col("item").alias(keys[0]))
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("key_rows"))
    total = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    return counts.where(F.col("key_rows") >= total * share).select(*keys)


def salted_join(
    large: DataFrame,
    other: DataFrame,
    keys: list[str],
    spread_by: list[str],
    how: str = "inner",
    share: float = 0.001,
    salts: int = 64,
) -> DataFrame:
    """Equi-join that splits the rows of hot keys of ``large`` over ``salts`` tasks.

    Rows of a hot key get a salt from the hash of ``spread_by``, all other rows salt 0; the rows of
    ``other`` are repeated per salt for the hot keys only. The list of hot keys is bounded by
    ``1 / share``, so it is small whatever the size of the tables.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"salting repeats the other side, which {how} joins would show")
    hot = F.broadcast(hot_keys(large, keys, share).withColumn("is_hot", F.lit(True)))
    # A null key matches nothing, so its rows can go anywhere.
    spread = F.coalesce(F.col("is_hot"), F.lit(False))
    for key in keys:
        spread = spread | F.col(key).isNull()
    salt = F.when(spread, F.pmod(F.xxhash64(*spread_by), F.lit(salts))).otherwise(0)
    left = large.join(hot, keys, "left").withColumn("salt", salt.cast("int")).drop("is_hot")
    every_salt = F.sequence(F.lit(0), F.lit(salts - 1))
    copies = F.when(F.col("is_hot"), every_salt).otherwise(F.array(F.lit(0)))
    right = (
        other.join(hot, keys, "left").withColumn("salt", F.explode(copies)).drop("is_hot")
    )
    return left.join(right, [*keys, "salt"], how).drop("salt")
