"""Near-duplicate documents by circulant MinHash, banding and exact Jaccard verification.

1. Each text becomes its set of five-word shingles, a digest of the set, and one key per band of
   its signature. The signature comes from two permutations, one of them circularly shifted.
2. Equal sets are one node, named by their smallest id; only nodes meet in buckets.
3. Every node of a bucket is compared with the bucket's smallest node. The links make a first
   labelling.
4. A bucket whose nodes all have one label needs nothing more: its other pairs could only repeat
   what is known. In the others all pairs of different labels are compared: as rows where a bucket
   is small, else block by block inside tasks, so that no bucket emits its pairs.
5. The components of all links give the label of each row.

Every link is confirmed on the full sets. A pair of similarity ``s`` meets in a bucket with
probability ``1 - (1 - s**rows) ** bands``: 0.99998 at 0.75 with the defaults, more above.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.arrow import octets, sliced
from plumbline.llm.shingles import Circulant, linked, shingle_sets
from plumbline.llm.stored import components, stored
from plumbline.llm.tokens import Powers

BANDS, ROWS, PERCENT = 40, 5, 75

#: A bucket of more nodes than this is compared in blocks instead of as rows.
ROWS_OF_PAIRS = 12
#: Nodes, and shingles, that a block of a large bucket has on average.
BLOCK_NODES, BLOCK_SHINGLES = 256, 400_000


def _signed(batches: Iterator[pa.RecordBatch], bands: int, rows: int) -> Iterator[pa.RecordBatch]:
    powers, circulant = Powers(), Circulant(bands, rows)
    for batch in sliced(batches, 1):
        sets = shingle_sets(octets(batch.column(1)), powers)
        some = [s for s in sets if len(s)]
        keys = circulant.band_keys(some)
        sizes = np.array([len(s) for s in sets], dtype=np.int64)
        offsets = np.concatenate(([0], np.cumsum((sizes > 0) * bands))).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array(sizes),
                pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys.reshape(-1))),
            ],
            names=["doc_id", "n_shingles", "digest", "bands"],
        )


def signatures(
    docs: DataFrame, text: str = "text", bands: int = BANDS, rows: int = ROWS
) -> DataFrame:
    """``(doc_id, n_shingles, digest, bands)`` for every row; a text without words has no digest."""
    return docs.select(F.col("doc_id").cast("long"), F.col(text).cast("string")).mapInArrow(
        partial(_signed, bands=bands, rows=rows),
        "doc_id long, n_shingles long, digest binary, bands array<bigint>",
    )


def _confirmed(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    powers, last, kept = Powers(), None, None
    for batch in batches:
        a, b = (batch.column(i).to_pylist() for i in (0, 1))
        left = shingle_sets(octets(batch.column(2)), powers)
        right = batch.column(3)
        found = []
        for i, node in enumerate(b):
            if node != last:
                last, kept = node, shingle_sets(octets(right.slice(i, 1)), powers)[0]
            if linked(left[i], kept, percent):
                found.append(i)
        yield pa.RecordBatch.from_arrays(
            [pa.array([x[i] for i in found], pa.int64()) for x in (a, b)], names=["a", "b"]
        )


def confirmed(pairs: DataFrame, texts: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs ``(a, b)`` whose full sets are similar enough; ``texts`` is ``(node, text)``."""
    one = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    other = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    return (
        pairs.join(one, "a")
        .join(other, "b")
        .select("a", "b", "text_a", "text_b")
        .mapInArrow(partial(_confirmed, percent=percent), "a long, b long")
    )


def _within(key: tuple, rows: pa.Table, percent: int) -> pa.Table:
    """Links between nodes of two blocks of a bucket, or of one block, that differ in label.

    A pair is compared only in the first of the bands that it shares. Once a pair is linked their
    labels count as one.
    """
    bucket = key[0].as_py()
    node, label, side = (rows.column(c).to_numpy().copy() for c in ("node", "label", "side"))
    bands = np.array(rows.column("bands").to_pylist())
    sets = shingle_sets(octets(rows.column("text")), Powers())
    sizes = np.array([len(s) for s in sets])
    alone = not side.any()
    found = []
    for i in np.flatnonzero(side == 0).tolist():
        others = np.flatnonzero(node > node[i]) if alone else np.flatnonzero(side == 1)
        others = others[label[others] != label[i]]
        small, large = np.minimum(sizes[others], sizes[i]), np.maximum(sizes[others], sizes[i])
        others = others[100 * small >= percent * large]
        if len(others):
            same = bands[others] == bands[i]
            first = bands[i][np.argmax(same, axis=1)]
            others = others[first == bucket]
        for j in others.tolist():
            if label[j] != label[i] and linked(sets[i], sets[j], percent):
                found.append((node[i], node[j]))
                label[label == label[j]] = label[i]
    return pa.table({c: pa.array([f[k] for f in found], pa.int64()) for k, c in enumerate("ab")})


def _blocks(members: DataFrame, nodes: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Links inside large buckets. The nodes of the bucket's most frequent label meet all blocks of
    the other nodes but none of their own."""
    counts = members.groupBy("h", "label").agg(
        F.count("*").alias("c"), F.sum("n_shingles").alias("s")
    )
    plan = counts.groupBy("h").agg(
        F.max_by("label", F.struct("c", "label")).alias("main"),
        F.sum("c").alias("c"),
        F.sum("s").alias("s"),
        F.max(F.struct("c", "label", "s")).alias("most"),
    )

    def blocks(nodes_, shingles_):
        return F.greatest(
            F.lit(1),
            F.ceil(nodes_ / F.lit(BLOCK_NODES)),
            F.ceil(shingles_ / F.lit(BLOCK_SHINGLES)),
        ).cast("int")

    plan = plan.select(
        "h",
        "main",
        blocks(F.col("most.c"), F.col("most.s")).alias("p"),
        blocks(F.col("c") - F.col("most.c"), F.col("s") - F.col("most.s")).alias("q"),
    )
    plan = stored(plan, "blocks")
    dealt = members.join(plan, "h").withColumn("is_main", F.col("label") == F.col("main"))
    # Main blocks are numbered from 0, the others from p. A group (x, y) compares block x with y.
    dealt = dealt.withColumn(
        "own", F.expr("CASE WHEN is_main THEN pmod(hash(node), p) ELSE p + pmod(hash(node), q) END")
    )
    partners = F.expr("sequence(CASE WHEN is_main THEN p ELSE 0 END, p + q - 1)")
    dealt = dealt.withColumn("partner", F.explode(partners)).select(
        "h",
        "node",
        "label",
        F.least("own", "partner").alias("x"),
        F.greatest("own", "partner").alias("y"),
        (F.col("own") > F.col("partner")).cast("int").alias("side"),
    )
    return (
        dealt.join(nodes.select("node", "bands"), "node")
        .join(texts, "node")
        .groupBy("h", "x", "y")
        .applyInArrow(lambda key, rows: _within(key, rows, percent), "a long, b long")
    )


def near_duplicates(
    docs: DataFrame,
    text: str = "text",
    percent: int = PERCENT,
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` for every row of ``docs``.

    ``component_id`` is the smallest id that can be reached over links, the own id included, and
    ``kept`` tells that it is the own one. Null, empty and blank texts have no shingles and are
    linked with nothing. Repeated rows share a component. Rows that repeat an id with another text
    are judged by their own text each. A row without an id is linked with nothing, has no component
    and is kept. Other columns of ``docs`` are not read; an empty table has no rows. Long texts are hashed in
    pieces of a megabyte and cost some sixty bytes a word.
    """
    signed = stored(signatures(docs, text, bands, rows), "signatures")
    named = signed.where("digest IS NOT NULL AND doc_id IS NOT NULL")
    classes = named.groupBy("digest").agg(
        F.min("doc_id").alias("node"),
        F.first("n_shingles").alias("n_shingles"),
        F.first("bands").alias("bands"),
    )
    nodes = stored(classes, "nodes")
    keys = nodes.select("node", "n_shingles", F.explode("bands").alias("h"))
    # Written first: a join of two plain shuffles can be split where one bucket fills a task, a join behind the
    # grouping that shares its shuffle cannot.
    grouped = keys.groupBy("h").agg(F.min("node").alias("center"), F.count("*").alias("size"))
    buckets = stored(grouped.where("size > 1"), "buckets")
    members = stored(keys.join(buckets, "h"), "members")

    # The texts that are compared, read from all documents once.
    meeting = stored(members.select("node").distinct(), "meeting")
    every = docs.select(F.col("doc_id").cast("long").alias("node"), F.col(text).cast("string").alias("text"))
    texts = stored(every.join(meeting, "node", "left_semi"), "texts")
    sizes = nodes.select(F.col("node").alias("center"), F.col("n_shingles").alias("other"))
    close = f"100 * least(n_shingles, other) >= {percent} * greatest(n_shingles, other)"
    stars = (
        members.where("node <> center")
        .select("node", "center", "n_shingles")
        .distinct()
        .join(sizes, "center")
        .where(close)
        .select(F.col("node").alias("a"), F.col("center").alias("b"))
    )
    stars = stored(stars, "pairs")
    first = stored(confirmed(stars, texts, percent), "stars")
    labels = stored(components(first), "labels")

    labelled = members.join(labels, "node", "left").select(
        "h", "node", "n_shingles", "size", F.coalesce("label", "node").alias("label")
    )
    labelled = stored(labelled, "labelled")
    mixed = stored(
        labelled.groupBy("h")
        .agg(F.min("label").alias("low"), F.max("label").alias("high"))
        .where("low < high")
        .select("h"),
        "mixed",
    )
    rest = stored(labelled.join(mixed, "h"), "rest")
    few = rest.where(F.col("size") <= ROWS_OF_PAIRS)
    pairs = (
        few.alias("l")
        .join(few.alias("r"), "h")
        .where(
            "l.node < r.node AND l.label <> r.label AND 100 * least(l.n_shingles, r.n_shingles)"
            f" >= {percent} * greatest(l.n_shingles, r.n_shingles)"
        )
        .select(F.col("r.node").alias("a"), F.col("l.node").alias("b"))
        .distinct()
        .join(stars, ["a", "b"], "left_anti")
    )
    many = rest.where(F.col("size") > ROWS_OF_PAIRS)
    second = confirmed(pairs, texts, percent).union(_blocks(many, nodes, texts, percent))
    lifted = labels.select(F.col("node").alias("b"), F.col("label").alias("a"))
    final = stored(components(second.union(lifted.select("a", "b"))), "labels")

    reached = classes_of(nodes, final)
    return (
        signed.select("doc_id", "n_shingles", "digest")
        .join(reached, "digest", "left")
        .select(
            "doc_id",
            "n_shingles",
            F.coalesce(F.when(F.col("doc_id").isNotNull(), F.col("label")), "doc_id").alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )


def classes_of(nodes: DataFrame, labels: DataFrame) -> DataFrame:
    """``(digest, label)`` for every set of shingles."""
    return nodes.join(labels, "node", "left").select(
        "digest", F.coalesce("label", "node").alias("label")
    )
