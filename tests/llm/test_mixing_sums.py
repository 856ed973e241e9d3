"""Counting by distinct context, and products by gate, give what an addition for each bit gives."""

import random

import numpy as np
import pytest

from plumbline.llm import mixing
from plumbline.llm.tokens import Powers


def forms(n, seed=3):
    r = random.Random(seed)
    words = [f"{a}{b}".encode() for a in "the of and to in a is it".split() for b in ("", "n", "rest", "é")]
    return [b" ".join([*r.choices(words, k=r.randint(0, 60)), mixing.END]) for _ in range(n)]


@pytest.mark.parametrize("step", [0, 2])
@pytest.mark.parametrize("repeated", [False, True])
def test_counts_are_those_of_single_bits(step, repeated):
    texts, powers = forms(40), Powers()
    counts = np.arange(40) % 3 + 1.0 if repeated else np.ones(40)
    found = mixing.events(texts, powers, step)
    want = np.zeros((2, mixing.slots_of(step)))
    for slots in found.slots:
        np.add.at(want, (found.bit, slots), counts[found.word])
    got = np.zeros(want.shape, dtype=np.uint32)
    mixing.counted(texts, counts, got, powers)
    assert (got == want).all() and got.sum() > 0


def test_a_context_that_comes_again_costs_no_further_additions(monkeypatch):
    texts, powers, added = [b"again and again \n"] * 400, Powers(), []

    class Watched:
        def at(self, table, cells, n):
            added.append(len(cells))
            np.add.__class__.at(np.add, table, cells, n)

    class Numpy:
        add = Watched()

        def __getattr__(self, name):
            return getattr(np, name)

    watched = Numpy()
    watched.add.reduceat = np.add.reduceat
    monkeypatch.setattr(mixing, "np", watched)
    tables = np.zeros((2, mixing.SLOTS), dtype=np.uint32)
    mixing.counted(texts, np.ones(400), tables, powers)
    size = sum(map(len, texts))
    assert tables.sum() == 8 * 7 * size
    assert sum(added) < 8 * size


def test_equal_keys_stay_in_order():
    r = np.random.default_rng(5)
    for n in (0, 1, 2, 5000):
        key = r.integers(0, 50, n).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        assert (mixing._in_order(key) == np.argsort(key, kind="stable")).all()


def test_weights_are_sums_by_gate():
    texts, powers = forms(60), Powers()
    tables = np.zeros((2, mixing.SLOTS))
    mixing.counted(texts, np.ones(60), tables, powers)
    mixer, plain = mixing.Mixer(), mixing.Mixer()
    seen = mixer.learn(texts, np.ones(60), tables, powers)
    for part in mixing.stream(texts, powers).blocks(mixing.TOGETHER):
        zeros = np.maximum(tables[0][part.slots] - (1 - part.bit), 0)
        ones = np.maximum(tables[1][part.slots] - part.bit, 0)
        odds = np.log((ones + mixing.PRIOR) / (zeros + mixing.PRIOR))
        inputs = np.concatenate((odds, np.ones((1, len(part.bit))), part.match[None]))
        gate = part.place * mixing.TRUST + mixing._trust(zeros[-1] + ones[-1])
        off = part.bit - mixing._squash((plain.weights[gate].T * inputs).sum(axis=0))
        for g in np.unique(gate):
            own = inputs[:, gate == g]
            norm = (own * own).sum(axis=1) + 1
            plain.weights[g] += mixing.RATE / (1 + plain.learned / 200) * (own * off[gate == g]).sum(axis=1) / norm
        plain.learned += 1
    assert np.allclose(mixer.weights, plain.weights, atol=1e-4)
    assert seen.sum() == 8 * sum(map(len, texts))
