"""A manifest of a dataset: hash trees in postorder append logs, proofs read by computed position.

Every row is a leaf. Leaves of one tree are ranked by a range partitioning, not in a window, and cut
into aligned blocks of ``2**bits`` leaves. A builder per block appends every node to the block's log as
it is completed, children before parents, so the log is a postorder. The roots of a tree's blocks are
the leaves of its next tier; a tree is finished by the tier that holds it in one block. The roots of
all trees are the leaves of a tree of their own.

A node of level ``l`` that ends at leaf ``j`` follows ``2 * j - popcount(j)`` nodes (every one bit of
``j`` is a full subtree to its left, of twice its leaves less one) and ``l`` nodes that end at the same
leaf. So a sibling is a slice of the log at a computed place: no search, no pointers.

Defined results. A null lang is a tree, a null doc_id is the smallest and is never tampered with. Rows
with one doc_id are leaves in the order of their digests; equal rows are interchangeable. Nulls hash as
``-``, empty texts as ``0:``. An empty table has no rows and no root. Other columns are not read, so they
may have any name. Texts are hashed where they are read, never moved, and of any length a row can have.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.stored import stored

#: Leaves of a block are two to this power; a log of a block has at most twice as many digests.
BITS = 8
#: Bytes of a digest in a log. Hashes are taken of digests as hexadecimal text.
WIDTH = 32


def field(value: str) -> str:
    """SQL for a value as it enters a leaf: ``-``, or its length in bytes, a colon, and the value."""
    return f"coalesce(concat(octet_length({value}), ':', {value}), '-')"


def leaves(docs: DataFrame) -> DataFrame:
    """``(tree, doc_id, leaf, shown)``: digests of every row, and of what it is tampered to."""
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    rows = docs.selectExpr(*[f"CAST({c} AS STRING) AS {c}" for c in fields])
    more = "CAST(CAST(n_chars AS DECIMAL(38, 0)) + 1 AS STRING)"
    whole = {n: f"sha2(concat({', '.join(field(n if c == 'n_chars' else c) for c in fields)}), 256)" for n in ("n_chars", more)}
    return rows.selectExpr(
        "lang AS tree",
        "CAST(doc_id AS BIGINT) AS doc_id",
        f"unhex({whole['n_chars']}) AS leaf",
        f"CASE WHEN crc32(doc_id) % 7 = 0 THEN unhex({whole[more]}) END AS shown",
    )


def ranked(rows: DataFrame, *order: str) -> DataFrame:
    """The rows of each ``tree`` with their ``rank`` from 0 by ``order``, and ``n``, the tree's rows.

    The rows are dealt by ranges of tree and order, so that a large tree spreads over many tasks. The
    place inside a partition and the rows of the partitions before it give the rank: only a row per
    partition and tree is summed up in one place.
    """
    place = F.monotonically_increasing_id()
    by = [F.asc_nulls_first(c) for c in ("tree", *order)]
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(tasks, *by).sortWithinPartitions(*by).withColumn("place", place)
    dealt = stored(dealt.withColumn("part", F.expr("place >> 33")), "ranked")
    counts = dealt.groupBy("part", "tree").agg(F.count("*").alias("rows"), F.min("place").alias("first"))
    # A row per partition and tree, at most the two added up.
    before = stored(
        counts.selectExpr(
            "part AS of_part",
            "tree AS of_tree",
            "sum(rows) OVER (PARTITION BY tree ORDER BY part) - rows - first AS shift",
            "sum(rows) OVER (PARTITION BY tree) AS n",
        ),
        "places",
    )
    found = dealt.join(before, F.expr("part = of_part AND tree <=> of_tree"))
    return found.selectExpr(*rows.columns, "place + shift AS rank", "n")


def _height(leaves_of_block: int, alone: bool, bits: int) -> int:
    return (leaves_of_block - 1).bit_length() if alone else bits


def _appended(digests: list[bytes], height: int) -> bytes:
    """The log of a tree of the given height: every node as it is completed."""
    log = bytearray()
    waiting: list[list[str]] = [[] for _ in range(height + 1)]
    last = len(digests) - 1
    for j, digest in enumerate(digests):
        log += digest
        waiting[0].append(digest.hex())
        for level in range(height):
            # A node is complete with its second child, or with the last leaf of all.
            if len(waiting[level]) < 2 and j < last:
                break
            node = hashlib.sha256("".join(waiting[level]).encode()).digest()
            log += node
            waiting[level].clear()
            waiting[level + 1].append(node.hex())
    return bytes(log)


def _built(rows: pa.Table, bits: int) -> pa.Table:
    rows = rows.sort_by("rank")
    digests, n = rows.column("leaf").to_pylist(), rows.column("n")[0].as_py()
    block = rows.column("block")[0].as_py()
    alone = n <= 1 << bits
    log = _appended(digests, _height(len(digests), alone, bits))
    return pa.table(
        {
            "tree": rows.column("tree").slice(0, 1),
            "rank": pa.array([block], pa.int64()),
            "n": pa.array([-(-n >> bits)], pa.int64()),
            "leaves": pa.array([len(digests)], pa.int64()),
            "leaf": pa.array([log[-WIDTH:]], pa.binary()),
            "log": pa.array([log], pa.binary()),
        }
    )


def tiers(nodes: DataFrame, bits: int = BITS) -> list[DataFrame]:
    """The logs of trees whose leaves are ``(tree, rank, n, leaf)``, from the leaves' tier upwards.

    A row of a tier is a block: ``(tree, rank, n, leaves, leaf, log)``, with its place among the ``n``
    blocks of its tree, its leaves, its root as ``leaf``, and its log. A tree's last tier has one block.
    """
    found = []
    while True:
        blocks = nodes.withColumn("block", F.expr(f"rank >> {bits}"))
        tier = stored(
            blocks.select("tree", "rank", "n", "leaf", "block")
            .groupBy("tree", "block")
            .applyInArrow(
                lambda key, rows: _built(rows, bits),
                "tree string, rank long, n long, leaves long, leaf binary, log binary",
            ),
            "tier",
        )
        found.append(tier)
        nodes = tier.where("n > 1")
        if nodes.isEmpty():
            return found


def _beside(rank: str, level: str, n: str) -> tuple[str, str, str]:
    """SQL for the node beside an ancestor of leaf ``rank``: its index, whether it exists, its side."""
    up = f"shiftright({rank}, {level})"
    return f"({up} ^ 1)", f"(shiftleft({up} ^ 1, {level}) < {n})", f"(({up} & 1) = 1)"


def _siblings(rank: str, leaves: str, log: str, height: str) -> str:
    """SQL for the siblings, from the bottom to the root, of leaf ``rank`` in the log of a block."""
    index, there, _ = _beside(rank, "l", leaves)
    end = f"(least(shiftleft({index} + 1, l), {leaves}) - 1)"
    place = f"(2 * {end} - bit_count({end}) + l)"
    part = f"if({there}, substring({log}, CAST({place} * {WIDTH} + 1 AS INT), {WIDTH}), X'')"
    levels = f"sequence(0, CAST({height} AS INT) - 1)"
    return f"if({height} > 0, aggregate(transform({levels}, l -> {part}), X'', (a, b) -> concat(a, b)), X'')"


def height_sql(n: str) -> str:
    """SQL for the levels of a tree of ``n`` leaves above its leaves."""
    return f"CASE WHEN {n} > 1 THEN length(conv({n} - 1, 10, 2)) ELSE 0 END"


def proofs(nodes: DataFrame, logs: list[DataFrame], above: DataFrame | None = None, bits: int = BITS) -> DataFrame:
    """The nodes ``(tree, rank, n, …)`` of the trees in ``logs`` with ``proof``, their siblings up to the
    root, one after the other. ``above`` is ``(tree, above)``: what follows the root of a tree.

    A block's own proof is found once and handed down to its nodes, so a node reads one block.
    """
    upper = None
    for tier in reversed(logs):
        blocks = tier.selectExpr("tree AS of_tree", "rank AS of_block", "n AS blocks", "leaves", "log")
        if above is None:
            tops = blocks.selectExpr("*", "X'' AS above")
        else:
            tops = blocks.join(
                above.selectExpr("tree AS above_tree", "above"), F.expr("of_tree <=> above_tree"), "left"
            ).selectExpr("of_tree", "of_block", "blocks", "leaves", "log", "coalesce(above, X'') AS above")
        if upper is not None:
            handed = _found(tier.where("n > 1").select("tree", "rank", "n"), upper, bits)
            handed = handed.selectExpr("tree AS up_tree", "rank AS up_rank", "proof")
            tops = tops.join(handed, F.expr("of_tree <=> up_tree AND of_block = up_rank"), "left").selectExpr(
                "of_tree", "of_block", "blocks", "leaves", "log",
                "CASE WHEN blocks > 1 THEN proof ELSE above END AS above",
            )
        upper = tops
    return _found(nodes, upper, bits)


def _found(nodes: DataFrame, blocks: DataFrame, bits: int) -> DataFrame:
    height = f"CASE WHEN blocks > 1 THEN {bits} ELSE {height_sql('leaves')} END"
    inside = _siblings("local", "leaves", "log", height)
    return (
        nodes.join(blocks, F.expr(f"tree <=> of_tree AND rank >> {bits} = of_block"))
        .withColumn("local", F.expr(f"rank & {(1 << bits) - 1}"))
        .selectExpr(*nodes.columns, f"concat({inside}, above) AS proof")
    )


def folded(leaf: str, proof: str, steps: list[tuple[str, str]]) -> str:
    """SQL for the root that a leaf and its siblings lead to; ``steps`` are ranks and sizes of the trees
    on its way. Digests are binary, the result is hexadecimal."""
    state = f"named_struct('h', lower(hex({leaf})), 'o', 1)"
    for rank, n in steps:
        _, there, right = _beside(rank, "l", n)
        beside = f"lower(hex(substring({proof}, s.o, {WIDTH})))"
        # Without a sibling a node is hashed alone and nothing is read.
        pair = f"if({there}, if({right}, concat({beside}, s.h), concat(s.h, {beside})), s.h)"
        step = f"named_struct('h', sha2({pair}, 256), 'o', s.o + if({there}, {WIDTH}, 0))"
        levels = f"if({n} > 1, sequence(0, CAST({height_sql(n)} AS INT) - 1), CAST(array() AS ARRAY<INT>))"
        state = f"aggregate({levels}, {state}, (s, l) -> {step})"
    return f"{state}.h"


def manifest(docs: DataFrame, bits: int = BITS) -> DataFrame:
    """Every row's leaf, the roots above it, its proof, and the root that the proof leads to."""
    rows = ranked(stored(leaves(docs), "leaves"), "doc_id", "leaf")
    rows = stored(rows, "ranks")
    logs = tiers(rows, bits)
    tops = logs[0].where("n = 1")
    for tier in logs[1:]:
        tops = tops.union(tier.where("n = 1"))
    # The trees' roots in order of their names are the leaves of one more tree.
    names = stored(tops.selectExpr("CAST(NULL AS STRING) AS tree", "tree AS name", "leaf"), "roots")
    roots = stored(ranked(names, "name"), "root_ranks")
    root_logs = tiers(roots, bits)
    upper = proofs(roots, root_logs, bits=bits)
    upper = upper.selectExpr("name AS tree", "leaf AS subroot", "rank AS tree_rank", "n AS trees", "proof AS above")
    upper = stored(upper, "subroots")
    found = proofs(rows, logs, upper, bits)
    top = upper.selectExpr("tree AS name", "subroot", "tree_rank", "trees")
    root = root_logs[-1].where("n = 1").selectExpr("lower(hex(leaf)) AS root")
    fold = folded("coalesce(shown, leaf)", "proof", [("rank", "n"), ("tree_rank", "trees")])
    return (
        found.join(top, F.expr("tree <=> name"))
        .selectExpr(
            "doc_id",
            "lower(hex(leaf)) AS leaf",
            "lower(hex(subroot)) AS subroot",
            "sha2(lower(hex(proof)), 256) AS proof_sha256",
            f"{fold} AS folded_root",
            "rank",
            "n AS tree_leaves",
        )
        # One row, or none where the table is empty.
        .withColumn("root", root.scalar())
        .withColumn("verified", F.expr("folded_root = root"))
        .select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified", "rank", "tree_leaves")
    )
