"""Every operator has defined results for nulls, empty and long texts, repeated rows and odd tables."""

import hashlib

import pytest
from pyspark.sql import functions as F

from plumbline.llm import (
    decontam,
    langid,
    licences,
    lines,
    neardup,
    pagetext,
    pieces,
    pii,
    quality,
    scoring,
)
from plumbline.llm.queries import vocabulary

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, hash int, label int"
LONG = "word another thing here now " * 20_000
ROWS = [
    (1, None, None, None, None, "k", 1, 2),
    (2, "", "en", "a", 0, None, None, None),
    (3, " \t\n ", "en", "a", 4, "k", 1, 1),
    (None, "the quick brown fox jumps over the lazy dog", "en", None, None, None, None, None),
    (5, "the quick brown fox jumps over the lazy dog", "en", "a", 43, "k", 3, 4),
    (5, "the quick brown fox jumps over the lazy dog", "en", "a", 43, "k", 3, 4),
    (7, LONG, "en", "b", len(LONG), "k", 5, 6),
    (8, "x" * 300_000, "zz", "b", 300_000, "k", 7, 8),
]
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).cache()


@pytest.fixture(scope="module")
def items(spark):
    rows = [(1, "quick brown fox jumps over the lazy dog"), (1, "quick brown fox jumps over the lazy dog"), (2, None), (None, "a b c"), (3, "")]
    return spark.createDataFrame(rows, "item_id long, text string")


@pytest.fixture(scope="module")
def model():
    return pieces.model_bytes(vocabulary())


def by_id(frame):
    out = {}
    for row in frame.collect():
        out.setdefault(row["doc_id"], []).append(row)
    return out


def operators(model, items):
    return {
        "pieces": lambda d: pieces.round_trips(d, model),
        "encoded": lambda d: pieces.encoded(d, model),
        "pii": lambda d: pii.counted(pii.personal_data(d)),
        "neardup": neardup.near_duplicates,
        "scoring": scoring.scored,
        "lines": lines.deduplicated,
        "licences": lambda d: licences.scanned(d, licences.known_digests(d.sparkSession)),
        "quality": lambda d: quality.judged(quality.ledger(d)),
        "langid": lambda d: langid.identified(langid.document_evidence(d)),
    }


NAMES = ["pieces", "encoded", "pii", "neardup", "scoring", "lines", "licences", "quality", "langid"]


@pytest.mark.parametrize("name", NAMES)
def test_empty_table(docs, items, model, name):
    assert operators(model, items)[name](docs.limit(0)).count() == 0


@pytest.mark.parametrize("name", NAMES)
def test_every_row_has_a_result_and_equal_rows_equal_ones(docs, items, model, name):
    found = by_id(operators(model, items)[name](docs))
    assert {k: len(v) for k, v in found.items()} == {1: 1, 2: 1, 3: 1, None: 1, 5: 2, 7: 1, 8: 1}
    assert found[5][0] == found[5][1]


def test_leaks_of_odd_tables(docs, items):
    found = decontam.leaks(docs, items)
    assert sorted((r["doc_id"] or 0, r["item_id"]) for r in found.collect()) == [(0, 1), (5, 1), (5, 1)]
    assert decontam.leaks(docs.limit(0), items).count() == 0
    assert decontam.leaks(docs, items.limit(0)).count() == 0
    assert decontam.decontaminated(docs, items).count() == 5


def test_page_texts_of_odd_tables(spark):
    rows = [(1, None, None, "x"), (2, "u", "", None), (None, "u", "  ", "x"), (3, "u", "<p>" * 2000, "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    assert [(r["text"], r["n_chars"]) for r in pagetext.main_texts(pages).collect()] == [("", 0)] * 4
    assert pagetext.main_texts(pages.limit(0)).count() == 0


def test_values_of_the_odd_rows(docs, items, model):
    found = by_id(operators(model, items)["pieces"](docs))
    assert {found[i][0]["n_tokens"] for i in (1, 2)} == {2}
    assert found[1][0]["decoded_sha256"] == EMPTY_SHA
    found = by_id(neardup.near_duplicates(docs))
    assert [found[i][0]["n_shingles"] for i in (1, 2, 3, 5, 7, 8)] == [0, 0, 0, 5, 5, 1]
    assert found[None][0]["component_id"] is None and found[None][0]["kept"]
    assert all(found[i][0]["component_id"] == i for i in (1, 2, 3, 5, 7, 8))
    found = by_id(lines.deduplicated(docs))
    assert [(found[i][0]["kept_text"], found[i][0]["n_lines"]) for i in (1, 2, 3)] == [("", 1), ("", 1), (" \t\n ", 2)]
    found = by_id(quality.ledger(docs))
    assert [found[i][0]["n_words"] for i in (1, 2, 3, 5, 7, 8)] == [0, 0, 0, 9, 100_000, 1]
    assert found[7][0]["n_repeat_words"] == 100_000
    found = by_id(langid.identified(langid.document_evidence(docs)))
    assert [found[i][0]["kept"] for i in (1, 2, 3, 5)] == [False, False, False, True]
    found = by_id(scoring.scored(docs))
    assert [found[i][0]["n_tokens"] for i in (1, 2, 3, 5, 7, 8)] == [1, 1, 1, 10, 100_001, 2]


def test_columns_of_the_documents_stay(docs):
    clashing = docs.withColumn("n_lines", F.lit("old")).withColumn("flags", F.lit(1)).withColumn("first", F.lit(2))
    found = lines.deduplicated(clashing)
    assert set(docs.columns) | {"flags", "first", "kept_text", "n_lines", "n_dropped"} == set(found.columns)
    assert langid.only_identified(docs).columns == docs.columns
