"""Intermediate tables in the shared folder, and connected components of links between ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.sources.workspace import work_dir


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the shared folder and read it again, which cuts its lineage."""
    path = work_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))")).first()
    return tuple(row)


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """The smallest id that can be reached from every linked id: ``(node, label)``.

    ``edges`` has two columns ``a`` and ``b``. Large stars and small stars alternate until the
    links no longer change; each round is a table of its own.
    """
    edges = stored(
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "links",
    )
    state = _state(edges)
    while state[0]:
        # The least of every node is written before it is joined: so the links of a node that has very many can
        # be split over tasks, and a task hands on one row per node.
        ways = _both_ways(edges)
        least = stored(ways.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m")), "least")
        large = (
            ways.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        )
        large = stored(large.where("a <> b").distinct(), "large")
        lowest = stored(large.groupBy("a").agg(F.min("b").alias("m")), "lowest")
        small = large.join(lowest, "a")
        edges = stored(
            small.select(F.col("b").alias("a"), F.col("m").alias("b"))
            .where("a <> b")
            .union(lowest.select("a", F.col("m").alias("b")))
            .distinct(),
            "links",
        )
        before, state = state, _state(edges)
        if state == before:
            break
    return (
        edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
        .union(edges.select(F.col("b"), F.col("b")))
        .distinct()
    )
