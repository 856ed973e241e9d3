"""Scores follow the order of words, repetition, and all training texts."""

import pickle
import random

import numpy as np
import pytest

from plumbline.llm import mixing, scoring
from plumbline.llm.tokens import Powers

SCHEMA = "doc_id long, text string"


def sentences(r, n):
    subjects, verbs, objects = "cat dog king queen farmer".split(), "sees likes paints finds".split(), "trees rivers towns".split()
    return " ".join(f"the {r.choice(subjects)} often {r.choice(verbs)} many {r.choice(objects)} ." for _ in range(n))


def test_order_and_repetition_change_the_score(spark):
    r = random.Random(4)
    rows = [(i, sentences(r, 20)) for i in range(100, 160)]
    fluent = sentences(r, 20)
    words = fluent.split()
    r.shuffle(words)
    odd = "zq vx wk jq xz kv"
    rows += [(1, fluent), (2, " ".join(words)), (3, odd), (4, " ".join([odd] * 20))]
    found = {x["doc_id"]: x for x in scoring.scored(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert found[1]["base_score"] == pytest.approx(found[2]["base_score"])
    assert found[2]["bits_per_byte"] > 1.2 * found[1]["bits_per_byte"]
    assert found[4]["bits_per_byte"] < 0.7 * found[3]["bits_per_byte"]


def test_long_texts_are_coded_as_one(monkeypatch):
    powers, r = Powers(), random.Random(5)
    forms = [scoring._form(sentences(r, 30).encode()) for _ in range(4)]
    tables = np.zeros((2, mixing.SLOTS))
    mixing.counted(forms, np.ones(4), tables, powers)
    mixer, odds = mixing.Mixer(), mixing.log_odds(tables)
    whole = mixer.lengths(forms, *odds, powers)
    monkeypatch.setattr(mixing, "CODED", 64)
    assert mixer.lengths(forms, *odds, powers) == pytest.approx(whole)
    assert [mixer.lengths([f], *odds, powers)[0] for f in forms] == pytest.approx(whole)


def test_every_training_text_is_learned_from(spark):
    r = random.Random(6)
    texts = [sentences(r, 3) for _ in range(40)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], SCHEMA).repartition(5)
    tables = scoring.predictors(docs, 1)
    want = np.zeros((2, mixing.slots_of(1)))
    mixing.counted([scoring._form(t.encode()) for t in texts], np.ones(40), want, Powers())
    assert (tables == want).all()
    mixer, size = scoring.learned(docs, tables), sum(len(scoring._form(t.encode())) for t in texts)
    assert (mixer.total - mixing.Mixer().total).sum() == pytest.approx(8 * size)
    assert not np.allclose(mixer.weights, mixing.Mixer().weights)


def test_tables_grow_with_the_words():
    steps = [mixing.step_for(n) for n in (0, 1 << 18, 1 << 19, 1 << 20, 1 << 40)]
    assert steps == [0, 0, 1, 2, 2] and mixing.LARGEST == 2


def test_counts_of_a_byte_and_more_are_handed_on_whole():
    import pyarrow as pa

    tables = np.zeros((2, mixing.SLOTS), dtype=np.uint32)
    tables[0, :5], tables[1, 3:6], tables[1, -1] = [1, 254, 255, 256, 70_000], [255, 9, 1 << 31], 300
    got = np.zeros((2, mixing.SLOTS))
    for row in scoring._cells_of(tables).to_pylist():
        both = pa.table({"block": [row["block"]] * 2, "counts": pa.array([row["counts"]] * 2, pa.binary())})
        part = np.frombuffer(scoring._added(both).column("counts")[0].as_py(), np.float32).reshape(2, -1)
        a = row["block"]
        got[:, a : a + scoring.SLOT_BLOCK] = part[:, : mixing.SLOTS - a]
    assert (got == 2.0 * tables).all()


def test_counts_reach_the_tasks_packed(spark):
    r = np.random.default_rng(7)
    tables = np.zeros((2, mixing.slots_of(1)), dtype=np.float32)
    at = r.integers(0, tables.size, 200_000)
    np.add.at(tables.reshape(-1), at, r.integers(1, 400, len(at)).astype(np.float32))
    tables[0, 1] = 2.0**35
    counts = scoring.Counts.of(tables)
    assert sum(map(len, counts.blocks.values())) < tables.nbytes / 16
    assert (counts.tables() == tables).all() and (counts.pairs() == mixing.paired(tables)).all()
    for got, want in zip(counts.odds(), mixing.log_odds(tables)):
        assert got.dtype == want.dtype and np.allclose(got, want)
    assert scoring.Counts(mixing.SLOTS, {}).odds()[0].any() == np.False_


def test_the_driver_holds_packed_counts_only(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"word{i} and word{i + 1}") for i in range(30)], SCHEMA)
    held = []
    monkeypatch.setattr(scoring, "learned", lambda texts, counts: held.append(counts) or mixing.Mixer())
    scoring.scored(docs)
    assert len(pickle.dumps(held[0])) < 8 * mixing.SLOTS / 16
