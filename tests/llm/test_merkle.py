"""The manifest of hash trees, against a plain version."""

import hashlib
import zlib

import pytest

from plumbline.llm import merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, leaf string, rank int, tree int"
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
ODD = [
    (None, "a", None, "s", 1),
    (4, None, None, None, None),
    (5, "", "", "", 0),
    (6, "é" * 3, "é", "s", 3),
    (6, "é" * 3, "é", "s", 3),
    (6, "other", "é", "s", 5),
    (7, "long " * 2_000_000, "en", "s", 9_223_372_036_854_775_807),
    (-8, "x", "en", "s", -1),
]


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(row, more=0):
    doc_id, text, lang, source, n_chars = row
    values = (doc_id, source, lang, None if n_chars is None else n_chars + more, text)
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def plain_levels(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([h(*below[i : i + 2]) for i in range(0, len(below), 2)])
    return levels


def plain_way(levels, i):
    """A sibling, or nothing, and whether it is to the left, for every level."""
    way = []
    for level in levels[:-1]:
        j = i ^ 1
        way.append((level[j] if j < len(level) else "", j < i))
        i //= 2
    return way


def plain(rows):
    trees = {}
    for row in rows:
        trees.setdefault(row[2], []).append(row)
    names = sorted(trees, key=lambda t: (t is not None, (t or "").encode()))
    for name in names:
        trees[name].sort(key=lambda r: (r[0] is not None, r[0] or 0, plain_leaf(r)))
    built = {name: plain_levels([plain_leaf(r) for r in trees[name]]) for name in names}
    top = plain_levels([built[name][-1][0] for name in names])
    found = []
    for place, name in enumerate(names):
        for i, row in enumerate(trees[name]):
            way = plain_way(built[name], i) + plain_way(top, place)
            shown = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0
            node = plain_leaf(row, int(shown))
            for beside, left in way:
                node = h(beside, node) if left else h(node, beside)
            found.append(
                (row[0], plain_leaf(row), built[name][-1][0], top[-1][0], h(*[b for b, _ in way]), node, node == top[-1][0])
            )
    return found


def ordered(rows):
    return sorted(map(tuple, rows), key=str)


def given(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA)


def found(docs, bits):
    return merkle.manifest(docs, bits).drop("rank", "tree_leaves").collect()


@pytest.mark.parametrize("bits", [1])
def test_odd_rows(spark, bits):
    assert ordered(found(given(spark, ODD), bits)) == ordered(plain(ODD))


@pytest.mark.parametrize("n", [1, 9, 65])
def test_sizes_around_blocks_and_tiers(spark, n):
    rows = [(i * 3, f"text {i}", "hot", "s", i) for i in range(n)] + [(1, "b", "few", None, None)]
    assert ordered(found(given(spark, rows), 2)) == ordered(plain(rows))


def test_empty_table(spark):
    empty = given(spark, ODD).limit(0)
    assert found(empty, 3) == []


def test_whole_table_at_production_size(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text", "lang", "source", "n_chars").collect()]
    assert ordered(found(docs, merkle.BITS)) == ordered(plain(rows))


def test_many_trees(spark):
    rows = [(i, "t", f"lang{i % 37}", "s", i) for i in range(150)]
    assert ordered(found(given(spark, rows), 2)) == ordered(plain(rows))


@pytest.mark.parametrize("n", [1, 2, 5, 8, 13])
def test_logs_are_postorders_at_computed_places(n):
    height = (n - 1).bit_length()
    digests = [hashlib.sha256(bytes([i])).digest() for i in range(n)]
    log = merkle._appended(digests, height)
    for level, nodes in enumerate(plain_levels([d.hex() for d in digests])):
        for i, node in enumerate(nodes):
            end = min((i + 1) << level, n) - 1
            place = 2 * end - end.bit_count() + level
            assert log[place * 32 : place * 32 + 32].hex() == node


def test_ranks_spread_over_tasks_without_a_window_over_rows(spark):
    docs = given(spark, [(i, "t", "hot", "s", 1) for i in range(400)])
    rows = merkle.ranked(merkle.leaves(docs), "doc_id", "leaf")
    assert sorted(r["rank"] for r in rows.select("rank").collect()) == list(range(400))
    assert {r["n"] for r in rows.select("n").distinct().collect()} == {400}
    assert "Window" not in rows._jdf.queryExecution().executedPlan().toString()
