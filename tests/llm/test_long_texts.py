"""One very long text costs an operator's worker little beside its own size, and gives the same result."""

import random
import subprocess
import sys

import numpy as np
import pytest

from plumbline.llm import decontam, langid, pii, shingles, tokens
from plumbline.llm.tokens import Powers

HEAD = """
import resource, sys
sys.path.insert(0, {path!r})
import numpy as np, pyarrow as pa
from plumbline.llm import decontam, langid, pii, shingles
from plumbline.llm.tokens import Powers
import pandas as pd
words = ("the river of an old town by the sea", "une ville au bord de la mer", "eine Stadt am Meer")
text = " ".join(words[i % 3] + str(i % 977) for i in range({n}))
used = lambda: resource.getrusage(resource.RUSAGE_SELF).ru_maxrss // 1024
"""
RUNS = {
    "pii": (
        1_050_000,
        """
text = text + " mail john [at] example [dot] com \\u0435 and the rest"
detector = pii.Detector(); start = used()
(found,) = [detector.spans(text, sign) for sign in detector.disguised([text])]
assert found[-1][4] == "john@example.com"
""",
    ),
    "neardup": (
        1_050_000,
        """
raw = text.encode(); powers = Powers(); start = used()
(found,) = shingles.shingle_sets([raw], powers)
assert len(found) > 900
shingles.Circulant(40, 5).band_keys([found])
""",
    ),
    "decontam": (
        1_050_000,
        """
batch = pa.RecordBatch.from_pydict({"id": [1], "text": [text + " " + "what flows here? the wendel"], "h": [5]})
postings = pd.DataFrame([(1, 0, w, 0.2) for w in decontam._terms([b"what flows here the wendel"], Powers()).hashes.view(np.int64)], columns=["item_id", "unit", "term", "share"])
index = decontam.Index(postings, [(1, b"what flows here? the wendel")]); start = used()
(out,) = decontam._leaks_of(iter([batch]), index, 0.5, 0.6)
assert out.num_rows == 1
""",
    ),
    "langid": (
        1_050_000,
        """
batch = pa.RecordBatch.from_pydict({"id": [1], "text": [text], "a": [1], "b": ["x"], "c": ["x"], "d": ["x"]}); start = used()
profile = np.log(np.full((5, langid.BUCKETS), 1 / langid.BUCKETS)).astype(np.float32)
(out,) = langid._scored(iter([batch]), profile)
assert out["n_grams"][0].as_py() > 1_000_000
""",
    ),
}


@pytest.mark.parametrize("name", sorted(RUNS))
def test_thirty_megabytes_fit_a_worker(name):
    n, body = RUNS[name]
    code = HEAD.format(path=sys.path[0], n=n) + body + "print(len(text) // 1_000_000, used() - start)"
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True)
    assert done.returncode == 0, done.stderr[-800:]
    size, used = map(int, done.stdout.split())
    assert size >= 29 and used < (650 if name == "pii" else 550)


def made(n, seed=1):
    r = random.Random(seed)
    return " ".join(r.choice(["été", "The", "a", "x1", "don't", "word", "\n", "ñ"]) + str(r.randint(0, 40)) for _ in range(n)).encode()


def test_pieces_have_the_words_of_the_whole(monkeypatch):
    text, powers = made(3000), Powers()
    for blank in (tokens._BLANK, decontam._APART):
        whole = tokens.words([text], powers, blank).hashes
        monkeypatch.setattr(tokens, "PIECE", 500)
        monkeypatch.setattr(tokens.cut, "__defaults__", (tokens._BLANK, 500))
        found, first = tokens.hashes([text], powers, blank)
        assert (found == whole).all() and first.tolist() == [0, len(whole)]
        monkeypatch.undo()


def test_trigrams_of_pieces_are_those_of_the_whole(monkeypatch):
    text = made(3000)
    whole = np.bincount(langid._buckets([text])[0], minlength=langid.BUCKETS)
    monkeypatch.setattr(langid, "PIECE", 500)
    monkeypatch.setattr(tokens.cut, "__defaults__", (tokens._BLANK, 500))
    pieces = list(langid._pieces([text, b"a", text], 600))
    assert len(pieces) > 20
    found = sum(np.bincount(langid._buckets(p)[0], minlength=langid.BUCKETS) for a, _, p in pieces if a == 0)
    assert (found == whole).all()


def test_passages_of_runs_are_those_of_the_whole(spark, monkeypatch):
    r = random.Random(3)
    items = [(i, " ".join(f"w{r.randint(0, 90)}" for _ in range(r.randint(3, 40)))) for i in range(30)]
    postings = decontam.index(spark.createDataFrame(items, "item_id long, text string")).toPandas()
    index = decontam.Index(postings, [(i, t.encode()) for i, t in items])
    monkeypatch.setattr(decontam, "SEARCHED", 128)
    for n in (1, 31, 64, 65, 128, 159, 160, 161, 193, 256, 288, 289, 700, 1001):
        text = " ".join(f"w{r.randint(0, 90)}" for _ in range(n)).encode()
        found = decontam._terms([text], Powers())
        same = lambda out: {k: sorted(v) for k, v in out[0].items()}
        assert same(index.retrieved(found.hashes, found.first, 0.3)) == same(index.candidates(found.hashes, found.first, 0.3))


def test_spans_of_odd_characters_lead_back():
    detector, r = pii.Detector(), random.Random(8)
    odd = [*list(detector.characters)[::40], "​", "é", "x", " ", "😀", "ﬁ"]
    for _ in range(300):
        text = "".join(r.choice(odd) for _ in range(r.randint(0, 60)))
        seen, back = detector._mapped(text)
        want = [(i, i + 1) for i, c in enumerate(text) for _ in detector.characters.get(c, c)]
        assert seen == "".join(detector.characters.get(c, c) for c in text) and back.T.tolist() == [list(w) for w in want]
