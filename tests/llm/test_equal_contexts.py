"""Bytes with equal contexts are read once, and count as often as they come."""

import random

import numpy as np
import pyarrow as pa
import pytest

from plumbline.llm import mixing, scoring
from plumbline.llm.tokens import Powers, words


def forms(n, seed=8):
    r = random.Random(seed)
    words = [f"{a}{b}".encode() for a in "the of and to in a is it".split() for b in ("", "n", "rest", "é")]
    return [b" ".join([*r.choices(words, k=r.randint(0, 60)), mixing.END]) for _ in range(n)]


def counted(texts, powers):
    tables = np.zeros((2, mixing.SLOTS), dtype=np.float32)
    mixing.counted(texts, np.ones(len(texts)), tables, powers)
    return tables


@pytest.mark.parametrize("work", ["learn", "lengths"])
def test_contexts_that_come_again_are_not_hashed_again(monkeypatch, work):
    texts, powers, hashed = [b"again and again and again \n"] * 400, Powers(), []
    tables, plain = counted(texts, powers), mixing._hashed

    def watched(context, *others):
        hashed.append(len(context))
        return plain(context, *others)

    monkeypatch.setattr(mixing, "_hashed", watched)
    monkeypatch.setattr(mixing, "ALONE", 0, raising=False)
    if work == "learn":
        mixing.Mixer().learn(texts, np.ones(400), tables, powers)
    else:
        mixing.Mixer().lengths(texts, *mixing.log_odds(tables), powers)
    assert sum(hashed) < 2 * sum(map(len, texts))


@pytest.mark.parametrize("repeated", [False, True])
def test_a_step_for_rows_is_one_for_their_bits(monkeypatch, repeated):
    texts, powers = forms(60), Powers()
    counts = np.arange(60) % 3 + 1.0 if repeated else np.ones(60)
    tables = counted(texts, powers)
    found = mixing.stream(texts, powers)
    assert len(found.value) < min(len(found.data) / 4, mixing.ROWS)
    monkeypatch.setattr(mixing, "ALONE", 0)
    mixer, plain = mixing.Mixer(), mixing.Mixer()
    seen = mixer.learn(texts, counts, tables, powers)
    part = found.events(0, len(found.data))
    zeros = np.maximum(tables[0][part.slots] - (1 - part.bit), 0)
    ones = np.maximum(tables[1][part.slots] - part.bit, 0)
    odds = np.log((ones + mixing.PRIOR) / (zeros + mixing.PRIOR))
    inputs = np.concatenate((odds, np.ones((1, len(part.bit))), part.match[None]))
    gate = part.place * mixing.TRUST + mixing._trust(zeros[-1] + ones[-1])
    weight = np.sqrt(counts)[part.word]
    off = (part.bit - mixing._squash((plain.weights[gate].T * inputs).sum(axis=0))) * weight
    for g in np.unique(gate):
        own = inputs[:, gate == g]
        norm = (own * own * weight[gate == g]).sum(axis=1) + 1
        plain.weights[g] += mixing.RATE * mixing.LARGER * (own * off[gate == g]).sum(axis=1) / norm
    assert np.allclose(mixer.weights, plain.weights, atol=1e-4)
    assert np.allclose(seen, np.bincount(gate, weight, mixing.GATES))
    assert np.allclose((mixer.ones - plain.ones).sum(axis=1), np.bincount(gate, weight * part.bit, mixing.GATES))


def test_lengths_by_rows_are_those_of_single_bits():
    texts, powers = forms(60), Powers()
    tables = counted(texts, powers)
    mixer, (odds, trust) = mixing.Mixer(), mixing.log_odds(tables)
    mixer.learn(texts, np.ones(60), tables, powers)
    part = mixing.events(texts, powers)
    gate = part.place * mixing.TRUST + trust[part.slots[-1] - mixing.OFFSETS[-2]]
    p = mixer._refined(mixer._mixed(odds[part.slots], gate, part.match), gate)
    want = np.bincount(part.word, -np.log2(np.where(part.bit == 1, p, 1 - p)))
    assert mixer.lengths(texts, odds, trust, powers) == pytest.approx(want, rel=1e-3)


def test_keys_that_share_their_upper_bits_stay_apart():
    for n in (0, 1, 2, 3000):
        key = np.arange(n, dtype=np.uint64) % np.uint64(7)
        order, new = mixing.in_order(key)
        assert (order == np.argsort(key, kind="stable")).all() and new.sum() == min(n, 7)


def test_a_word_of_a_batch_is_looked_up_once(monkeypatch):
    texts, looked_up = ["again and again", "and so on and on", "so"] * 50, []

    class Numpy:
        def __getattr__(self, name):
            return getattr(np, name)

        def searchsorted(self, table, keys, *others):
            looked_up.append(np.size(keys))
            return np.searchsorted(table, keys, *others)

    known = words([b"again", b"and"], Powers()).hashes
    frequent = np.sort(np.append(known, np.uint64(2**64 - 1)))
    monkeypatch.setattr(scoring, "np", Numpy())
    batch = pa.RecordBatch.from_pydict({"row_key": pa.array(range(150), pa.int64()), "text": pa.array(texts)})
    table, counts = (frequent, np.array([5.0, 7.0, 9.0])), scoring.Counts(mixing.SLOTS, {})
    rows = pa.Table.from_batches(scoring._summed(iter([batch]), table, (21, 3), mixing.Mixer(), counts)).to_pylist()
    assert sum(looked_up) == 1 + 4
    sums = [r for r in rows if r["ends"]]
    assert [r["known"] for r in sums] == [4, 3, 1] * 50 and [r["tokens"] for r in sums] == [4, 6, 2] * 50
    others = [(r["row_key"], r["times"]) for r in rows if not r["ends"]]
    assert sorted(others) == sorted((i, n) for i in range(150) for n in ([], [1, 2], [1])[i % 3])
