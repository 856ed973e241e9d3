"""Ranked search against a plain version, and what pair bounds skip."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from plumbline.llm import lexical
from plumbline.llm.tokens import cut

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms_of(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain(docs, items, best):
    counted = [(doc_id, Counter(terms_of(text))) for doc_id, text in docs]
    counted = [(d, c, sum(c.values())) for d, c in counted if c]
    n, length = len(counted), sum(size for _, _, size in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    asked = {}
    for item_id, text in items:
        asked.setdefault(item_id, set()).update(terms_of(text))
    found = []
    for item_id, terms in asked.items():
        scores = []
        for doc_id, c, size in counted:
            m = 100 - 50 + (50 * size * n) // length
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 20 * m))
                for t in terms
                if t in c
            )
            if score > 0:
                scores.append((-score, doc_id is not None, doc_id or 0))
        for rank, (score, there, doc_id) in enumerate(sorted(scores)[:best], 1):
            found.append((item_id, rank, doc_id if there else None, -score))
    return sorted(found, key=str)


def got(spark, docs, items, **options):
    given = spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id long, text string, score string, terms int")
    asked = spark.createDataFrame([(*i, 3) for i in items], "item_id long, text string, rank int")
    return sorted(map(tuple, lexical.ranked(given.repartition(3), asked, **options).collect()), key=str)


ODD_DOCS = [
    (1, None), (2, ""), (3, " .,; "), (None, "The the CAT-sat é"), (5, "cat"), (5, "cat"), (6, "CAT cat cat"), (-7, "éÉ été naïve"),
    (8, "cat " * 300_000 + "zebra"), (9, "x" * 400_000 + " cat"), (10, "a\x00b_c"), (11, "dog cat"), (12, "dog"),
]
ODD_ITEMS = [
    (1, "Cat?"), (1, "zebra cat"), (2, None), (3, ""), (None, "dog, cat; the É"), (4, "unknown words"), (5, "été a b c naïve"),
]


def test_odd_rows(spark):
    for best, postings in ((50, 1 << 19), (2, 3)):
        assert got(spark, ODD_DOCS, ODD_ITEMS, best=best, postings=postings) == plain(ODD_DOCS, ODD_ITEMS, best)


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert lexical.ranked(docs, items).count() == 0
    assert lexical.ranked(items.selectExpr("item_id AS doc_id", "text"), items.limit(0)).count() == 0


def made(seed, n):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    weights = [1 / (i + 1) for i in range(400)]
    return [(i, " ".join(r.choices(words, weights, k=r.randint(1, 80)))) for i in range(n)]


@pytest.mark.parametrize("terms_a_pass", [1 << 18, 40])
def test_many_shards_ties_and_passes(spark, terms_a_pass):
    docs = made(1, 600)
    docs += [(1000 + i, docs[i % 7][1]) for i in range(300)]
    items = [(i, text) for i, (_, text) in enumerate(made(2, 12))]
    assert got(spark, docs, items, best=10, postings=400, terms_a_pass=terms_a_pass) == plain(docs, items, 10)


def shard_of(seed, n=300, size=60):
    r = np.random.default_rng(seed)
    doc, term = np.nonzero(r.random((n, size)) < 1 / (1 + np.arange(size)))
    impact = r.integers(1, 1000, len(doc)) * (1 + term)
    pairs = np.array([(i, i + 1) for i in range(0, size, 2)], dtype=np.int32)
    return lexical.Shard.built(term.astype(np.int32), doc.astype(np.int32), impact, pairs, n), doc, term, impact


@pytest.mark.parametrize("seed", range(5))
def test_best_of_a_shard_is_whole(seed):
    shard, doc, term, impact = shard_of(seed)
    r = np.random.default_rng(seed + 100)
    for _ in range(60):
        first = np.sort(r.choice(30, 8, replace=False)) * 2
        terms = np.stack((first, first + 1), axis=1).reshape(-1).astype(np.int32)
        pair_at = np.full(len(terms), -1, dtype=np.int32)
        pair_at[::2] = first // 2
        held = np.isin(term, terms)
        scores = np.bincount(doc[held], impact[held], 300).astype(np.int64)
        least = int(np.sort(scores)[-r.integers(1, 40)])
        found, got_scores = lexical.best_of(shard, lexical._units(shard, terms, pair_at), max(least, 1))
        want = np.flatnonzero(scores >= max(least, 1))
        assert found.tolist() == want.tolist() and got_scores.tolist() == scores[want].tolist()


def test_pair_bounds_skip_more_than_single_maxima():
    shard, doc, term, impact = shard_of(3)
    paired = alone = 0
    for start in range(0, 44, 2):
        terms = np.arange(start, start + 16, dtype=np.int32)
        pair_at = np.full(16, -1, dtype=np.int32)
        pair_at[::2] = np.arange(start // 2, start // 2 + 8)
        held = np.isin(term, terms)
        least = int(np.sort(np.bincount(doc[held], impact[held], 300))[-5])
        looked = []
        for pairs in (pair_at, np.full(16, -1, dtype=np.int32)):
            units = lexical._units(shard, terms, pairs)
            bounds = np.array([max(0 if p is None else shard.pair_tops[p], max(shard.tops[a] for a in lists)) for lists, p in units])
            order = np.argsort(bounds, kind="stable")
            looked.append(len(lexical._candidates(shard, units, order, np.cumsum(bounds[order]) - bounds[order], least)))
        paired, alone = paired + looked[0], alone + looked[1]
    assert paired < alone


def test_long_texts_are_cut_between_terms():
    r = random.Random(4)
    for _ in range(200):
        text = "".join(r.choice("ab é.\n") for _ in range(r.randint(0, 400))).encode()
        pieces = list(cut(text, lexical.BETWEEN, r.randint(1, 30)))
        assert b"".join(pieces) == text
        assert [t for p in pieces for t in terms_of(p.decode())] == terms_of(text.decode())
