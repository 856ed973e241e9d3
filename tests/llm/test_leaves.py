"""Counting adds a byte once to a tree of contexts, and gives zeros and ones of every bit."""

import pickle
import random

import numpy as np
import pytest

from plumbline.llm import mixing, scoring
from plumbline.llm.tokens import Powers


def forms(n, seed=9):
    r = random.Random(seed)
    return [b" ".join([*(r.randbytes(r.randint(1, 9)).hex().encode() for _ in range(20)), mixing.END]) for _ in range(n)]


def test_a_byte_is_added_once_to_each_half_of_its_contexts(monkeypatch):
    texts, powers, added = forms(30), Powers(), []

    class Watched:
        def __getattr__(self, name):
            return getattr(np.add, name)

        def at(self, table, cells, n):
            added.append(len(cells))
            np.add.at(table, cells, n)

    class Numpy:
        add = Watched()

        def __getattr__(self, name):
            return getattr(np, name)

    monkeypatch.setattr(mixing, "np", Numpy())
    tables = np.zeros((2, mixing.SLOTS), dtype=np.uint32)
    mixing.counted(texts, np.ones(30), tables, powers)
    size = sum(map(len, texts))
    assert tables.sum() == 8 * 7 * size
    # Five predictors are hashed, each by two halves.
    assert sum(added) <= 5 * 2 * size


@pytest.mark.parametrize("step", [0, 1])
def test_packed_leaves_are_packed_zeros_and_ones(step):
    texts, powers = forms(40), Powers()
    events = mixing.events(texts, powers, step)
    want = np.zeros((2, mixing.slots_of(step)), dtype=np.uint32)
    for slots in events.slots:
        np.add.at(want, (events.bit, slots), 1)
    leaves = np.zeros(mixing.slots_of(step), dtype=np.uint32)
    mixing.gathered(texts, np.ones(40), leaves, powers)
    assert leaves.sum() == 7 * events.bit.size // 8 + 5 * events.bit.size // 8
    assert scoring._cells_of(leaves).equals(scoring._cells_of(want))
    assert (mixing.nodes_of(leaves) == want).all()


def test_slots_that_no_text_meets_are_not_handed_on():
    assert scoring._cells_of(np.zeros(mixing.SLOTS, dtype=np.uint32)).num_rows == 0


def test_a_task_lets_go_of_blocks_that_it_has_unpacked():
    texts, powers = forms(20), Powers()
    tables = np.zeros((2, mixing.SLOTS), dtype=np.uint32)
    mixing.counted(texts, np.ones(20), tables, powers)
    counts = scoring.Counts.of(tables.astype(np.float32))
    task, other = pickle.loads(pickle.dumps(counts)), pickle.loads(pickle.dumps(counts))
    for got, want in zip((*task.left(), *other.odds()), (*counts.left(), *counts.odds())):
        assert (got == want).all()
    assert counts.blocks and not task.blocks and not other.blocks


def test_tables_begin_where_a_line_of_cache_does():
    texts, powers = forms(5), Powers()
    tables = np.zeros((2, mixing.SLOTS), dtype=np.float32)
    mixing.counted(texts, np.ones(5), tables, powers)
    counts = scoring.Counts.of(tables)
    assert counts.left()[0].ctypes.data % mixing.LINE == counts.odds()[0].ctypes.data % mixing.LINE == 0


@pytest.mark.parametrize("texts", [[b"\n"], [b"\n"] * 9, [b"ab ab ab ab ab ab \n", b"b \n", b"ab ab ab \n"], [b"abc abc abc \n"] * 66_000])
def test_expected_bytes_are_those_that_came_where_six_bytes_stood_last(texts):
    found = mixing.stream(texts, Powers())
    own = texts if len(texts) < 100 else texts[:3]
    want = []
    for text in own:
        seen = {}
        for i in range(len(text)):
            six = text[i - 6 : i] if i >= 6 else None
            want.append(seen.get(six, -1) if six else -1)
            if six:
                seen[six] = text[i]
    assert found.expected[: len(want)].tolist() == want
    assert len(texts) == len(own) or (found.expected.reshape(len(texts), -1) == want[: len(texts[0])]).all()
