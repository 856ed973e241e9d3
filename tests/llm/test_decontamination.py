"""Decontamination against a plain version of the whole query."""

import math
import random
import re
from collections import Counter

import pytest

from plumbline.llm import decontam

SF_DIR = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def words_of(text):
    return WORD.findall((text or "").lower())


def halves(text):
    question, answer = decontam._question_and_answer(text.lower().encode())
    return words_of(question.decode()), words_of(answer.decode())


def grams(words, size):
    size = min(size, len(words))
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if size else set()


def split(words):
    """Parts of at most ``UNIT`` words, the first ones a word longer where they do not come out even."""
    n = -(-len(words) // decontam.UNIT)
    size, more = divmod(len(words), n) if n else (0, 0)
    at = 0
    for k in range(n):
        yield words[at : at + size + (k < more)]
        at += size + (k < more)


def plain(docs, items):
    units = [(i, part) for i, text in items for part in split(words_of(text))]
    n, mean = len(units), sum(len(u) for _, u in units) / len(units)
    df = Counter(w for _, u in units for w in set(u))
    shares = []
    for item, unit in units:
        weight = {
            w: math.log(1 + (n - df[w] + 0.5) / (df[w] + 0.5))
            * tf * (decontam.K1 + 1) / (tf + decontam.K1 * (1 - decontam.B + decontam.B * len(unit) / mean))
            for w, tf in Counter(unit).items()
        }
        shares.append((item, {w: x / sum(weight.values()) for w, x in weight.items()}))
    texts = dict(items)
    found = {}
    for doc, text in docs:
        words = words_of(text)
        starts = range(0, max(1, len(words) - decontam.PASSAGE + decontam.STRIDE), decontam.STRIDE)
        for s in starts:
            passage = set(words[s : s + decontam.PASSAGE])
            best = {}
            for item, share in shares:
                score = sum(x for w, x in share.items() if w in passage)
                best[item] = max(best.get(item, 0), score)
            for item, score in best.items():
                if score < decontam.THRESHOLD:
                    continue
                question, answer = halves(texts[item])
                reach = len(question) + len(answer)
                near = words[max(0, s - reach) : s + decontam.PASSAGE + reach]
                parts = []
                for own, size in ((question, 3), (answer, 1)):
                    size = min(size, len(own))
                    parts.append(len(grams(own, size) & grams(near, size)) / len(grams(own, size)) if own else 1.0)
                old = found.get((doc, item), (0, (0, 0)))
                found[doc, item] = (max(old[0], score), max(old[1], tuple(parts), key=lambda x: (min(x), sum(x))))
    return {k: v for k, v in found.items() if min(v[1]) >= decontam.OVERLAP}


def got(spark, docs, items):
    rows = decontam.leaks(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    ).collect()
    return {(r["doc_id"], r["item_id"]): (r["score"], (r["question_overlap"], r["answer_overlap"])) for r in rows}


def same(found, want):
    assert found.keys() == want.keys()
    for key, (score, parts) in want.items():
        assert found[key][0] == pytest.approx(score) and found[key][1] == pytest.approx(parts)


QUESTION = "Which river runs through the old town and meets the sea behind the harbour wall"
ANSWER = "the quiet brown Wendel flows there"


def test_the_answer_must_stand_near_the_question(spark):
    r = random.Random(1)
    noise = lambda n: " ".join(f"n{r.randint(0, 500)}" for _ in range(n))
    scattered = f"{QUESTION}. " + " ".join(f"{noise(1800)} {w}" for w in ANSWER.split())
    items = [(1, f"{QUESTION}? {ANSWER}."), (2, f"What is {noise(60)}? It is {noise(12)}.")]
    docs = [
        (1, f"{noise(200)} {QUESTION}? {ANSWER}. {noise(200)}"),
        (2, scattered),
        (3, f"{noise(300)} {QUESTION}? {noise(15)} {ANSWER}"),
        (4, f"{QUESTION}? {noise(400)}"),
        (5, f"{ANSWER} {noise(300)} {QUESTION}"),
        (6, f"{noise(90)} {items[1][1].upper()} {noise(90)}"),
        (7, None),
        (8, ""),
    ]
    found = got(spark, docs, items)
    same(found, plain(docs, items))
    assert sorted(found) == [(1, 1), (3, 1), (6, 2)]


def test_made_documents(spark):
    r = random.Random(4)
    vocabulary = [f"w{i}" for i in range(150)]
    some = lambda n: " ".join(r.choices(vocabulary, weights=range(1, 151), k=n))
    items = [(i, f"{some(r.randint(2, 70))}. {some(r.randint(1, 9))}") for i in range(40)]
    docs = []
    for i in range(120):
        words = f"{some(r.randint(0, 150))} {r.choice(items)[1]} {some(r.randint(0, 150))}".split()
        docs.append((i, " ".join(w for w in words if r.random() > 0.1)))
    same(got(spark, docs, items), plain(docs, items))


def test_given_tables(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").select("item_id", "text").collect()]
    same(got(spark, docs, items), plain(docs, items))
