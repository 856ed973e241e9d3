"""Token counts against the library."""

import random

import pytest
import sentencepiece

from plumbline.llm import pieces, tokencounts
from plumbline.llm.queries import vocabulary

ODD = [
    "", " ", "  a  b\n\n c", "▁a▁ b", "x\r\ny", "a" * 3000, "▁" * 40, " " * 77 + "x", "𝒳🎉é", "<s> </s> <0x0A> <unk>",
    "ab;\r\n", "\t ▁ \t", "été,là!!»«", "don't", "\x00a\x00", "​ x ﻿", "中文字，。", "...." * 500, "0123456789" * 200,
]


@pytest.fixture(scope="module")
def model():
    return pieces.model_bytes(vocabulary())


@pytest.fixture(scope="module")
def library(model):
    return sentencepiece.SentencePieceProcessor(model_proto=model)


@pytest.fixture(scope="module")
def counter(model):
    return tokencounts.Counter(model, tokencounts.whole_tokens(model))


def test_odd_rows(spark, model, library):
    rows = [(i, t, "x", 7) for i, t in enumerate(ODD)] + [(None, "no id", "x", 1), (50, None, "x", 1), (3, ODD[3], "x", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_bytes string, n_tokens int")
    found = sorted(map(tuple, tokencounts.token_counts(docs, model, limit=100).collect()), key=str)
    want = []
    for doc_id, text, *_ in rows:
        n = len(library.encode(text or ""))
        want.append((doc_id, len((text or "").encode()), n, n > 100))
    assert found == sorted(want, key=str)
    assert tokencounts.token_counts(docs.limit(0), model).count() == 0


def test_whole_table(spark, model, library):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    want = {r["doc_id"]: len(library.encode(r["text"] or "")) for r in docs.collect()}
    found = tokencounts.token_counts(docs, model).collect()
    assert {r["doc_id"]: r["n_tokens"] for r in found} == want
    assert all(r["over_limit"] == (want[r["doc_id"]] > 4096) for r in found)


def test_made_texts(counter, library):
    r = random.Random(5)
    made = ["".join(r.choice("▁ab cdeth\n.,;'-é0X\t中  ") for _ in range(r.randint(0, 60))) for _ in range(5000)]
    assert counter.count(made) == [len(library.encode(t)) for t in made]


def test_every_proven_string_is_one_token_beside_others(counter, library):
    proven = list(counter.proven)
    assert len(proven) > 10_000
    r = random.Random(2)
    for _ in range(300):
        words = [w for w in r.sample(proven, 30) if w.startswith("▁") and w.strip("▁").isalpha()]
        text = "".join(words).replace("▁", " ").strip(" ")
        assert counter.count([text]) == [len(library.encode(text))]
    assert all(counter.known[w] == 1 for w in proven)


def test_windows_part_a_text_as_one_search_does(counter):
    r = random.Random(9)
    for _ in range(300):
        text = "".join(r.choice("▁ab cd\n.;'é  ") for _ in range(r.randint(1, 300)))
        whole = counter.segments.findall("▁" + text.replace(" ", "▁"))
        assert [s for part in counter.windows(text, r.randint(2, 40)) for s in part] == whole


def test_memory_forgets_and_keeps_its_proof(model, library, monkeypatch):
    monkeypatch.setattr(tokencounts, "REMEMBERED", 5)
    own = tokencounts.Counter(model, tokencounts.whole_tokens(model))
    for i in range(50):
        text = f"zq{i} xw{i}y the zq{i} " + "k" * 60
        assert own.count([text]) == [len(library.encode(text))]
    assert set(own.proven) <= set(own.known) and len(own.known) < len(own.proven) + 20


def test_a_long_text_takes_little_memory(model):
    """30 MB of text in a process of its own."""
    import subprocess
    import sys

    code = f"""
import resource, sys
sys.path.insert(0, {str(sys.path[0])!r})
from plumbline.llm import pieces, tokencounts
from plumbline.llm.queries import vocabulary
model = pieces.model_bytes(vocabulary())
counter = tokencounts.Counter(model, tokencounts.whole_tokens(model))
start = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
text = "some words of a text that goes on and on; " * 714_286
assert counter.count([text])[0] > 5_000_000
print((resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - start) // 1024)
"""
    used = int(subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True).stdout)
    assert used < 400
