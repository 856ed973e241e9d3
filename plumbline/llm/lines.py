"""Line deduplication with levelled sorted runs of line hashes.

Documents come in batches by id. A batch reduces its lines to distinct keys, anti-joins the runs
of earlier batches, and writes what is new as a sorted run of its own. Two runs of a level are
compacted into one of the next level, so a batch meets only a logarithm of runs. As batches come in
the order of ids, a run holds with each key the smallest id that has it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.stored import stored

BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

SHORTEST, BATCHES, FAN = 10, 4, 2


def line_key(line: Column) -> Column:
    """The line without blanks at its ends, A-Z in lower case."""
    return F.translate(F.btrim(line, F.lit(BLANKS)), UPPER, LOWER)


def text_lines(text: Column) -> Column:
    return F.split(F.coalesce(text.cast("string"), F.lit("")), "\n", -1)


def _hashed(docs: DataFrame, text: str, shortest: int) -> DataFrame:
    """Each row's lines as two hashes of 64 bits; null for keys that are too short to count."""
    keys = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64(text).alias("text_hash"),
        F.posexplode(F.transform(text_lines(F.col(text)), line_key)).alias("pos", "key"),
    )
    counts = F.col("doc_id").isNotNull() & (F.char_length("key") >= shortest)
    return keys.select(
        "doc_id",
        "text_hash",
        "pos",
        F.when(counts, F.xxhash64("key")).alias("h1"),
        F.when(counts, F.xxhash64(F.lit("second"), "key")).alias("h2"),
    )


def _sorted_run(df: DataFrame) -> DataFrame:
    return stored(df.repartition("h1", "h2").sortWithinPartitions("h1", "h2"), "run")


def first_holders(keys: DataFrame, batches: int = BATCHES, fan: int = FAN) -> DataFrame:
    """``(h1, h2, first)``: the smallest id of each key in ``keys (doc_id, h1, h2)``."""
    shares = [i / batches for i in range(1, batches)]
    cuts = sorted(set(keys.stat.approxQuantile("doc_id", shares, 0.01))) if shares else []
    bounds = [None, *[int(c) for c in cuts], None]
    levels: dict[int, list[DataFrame]] = {}
    for low, high in zip(bounds[:-1], bounds[1:]):
        batch = keys
        if low is not None:
            batch = batch.where(F.col("doc_id") > low)
        if high is not None:
            batch = batch.where(F.col("doc_id") <= high)
        fresh = batch.groupBy("h1", "h2").agg(F.min("doc_id").alias("first"))
        for runs in levels.values():
            for run in runs:
                fresh = fresh.join(run, ["h1", "h2"], "left_anti")
        levels.setdefault(0, []).append(_sorted_run(fresh))
        level = 0
        while len(levels[level]) >= fan:
            merged = reduce(DataFrame.unionByName, levels.pop(level))
            levels.setdefault(level + 1, []).append(_sorted_run(merged))
            level += 1
            levels.setdefault(level - 1, [])
    return reduce(DataFrame.unionByName, [run for runs in levels.values() for run in runs])


def deduplicated(
    docs: DataFrame, text: str = "text", shortest: int = SHORTEST, batches: int = BATCHES
) -> DataFrame:
    """``docs`` with ``kept_text``, ``n_lines`` and ``n_dropped`` added.

    A line goes if its key has at least ``shortest`` code points and a document of a smaller id has
    it too. Repetitions inside the first document stay. A null or empty text is one empty line.
    Rows without an id neither lose lines nor make others lose them. Repeated rows lose the same
    lines; rows that share an id but not the text count as one document and lose no line to each
    other. Columns of ``docs`` that are called like the three new ones are replaced.
    """
    hashed = stored(_hashed(docs, text, shortest), "lines")
    keyed = hashed.where("h1 IS NOT NULL")
    firsts = first_holders(keyed.select("doc_id", "h1", "h2"), batches)
    later = (
        keyed.join(firsts, ["h1", "h2"])
        .where("doc_id > first")
        .select("doc_id", "text_hash", "pos")
        .distinct()
    )
    # One flag for each line of the documents that lose some, in order.
    dropped = (
        hashed.join(later.select("doc_id", "text_hash").distinct(), ["doc_id", "text_hash"], "left_semi")
        .select("doc_id", "text_hash", "pos")
        .distinct()
        .join(later.withColumn("drop", F.lit(True)), ["doc_id", "text_hash", "pos"], "left")
        .groupBy("doc_id", "text_hash")
        .agg(F.sort_array(F.collect_list(F.struct("pos", F.coalesce("drop", F.lit(False)).alias("drop")))).alias("flags"))
        .select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), F.col("flags").alias("_flags"))
    )
    lines = text_lines(F.col(text))
    joined = docs.drop("kept_text", "n_lines", "n_dropped").join(
        dropped,
        (F.col("doc_id").cast("long") == F.col("_id")) & (F.xxhash64(text) == F.col("_hash")),
        "left",
    )
    kept = F.filter(
        F.zip_with(lines, F.col("_flags.drop"), lambda line, drop: F.when(~drop, line)),
        lambda line: line.isNotNull(),
    )
    return joined.select(
        *[c for c in docs.columns if c not in ("kept_text", "n_lines", "n_dropped")],
        F.when(F.col("_flags").isNull(), F.coalesce(F.col(text).cast("string"), F.lit("")))
        .otherwise(F.array_join(kept, "\n"))
        .alias("kept_text"),
        F.size(lines).cast("long").alias("n_lines"),
        F.when(F.col("_flags").isNull(), F.lit(0))
        .otherwise(F.size(F.filter(F.col("_flags.drop"), lambda drop: drop)))
        .cast("long")
        .alias("n_dropped"),
    )
