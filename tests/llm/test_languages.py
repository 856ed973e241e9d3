"""Languages that are none of the fixed ones."""

import numpy as np
import pytest

from plumbline.llm import langid

SF_DIR = "/root/testdata/sf0.001"
EVIDENCE = "doc_id long, text string, declared string, host string, suffix string"
POLISH = "wczoraj poszliśmy do parku, a potem wróciliśmy do domu, żeby zjeść kolację z przyjaciółmi przy stole"
ODD = {
    1001: ("这是一个关于天气的文件，我们今天去公园散步，然后回家吃饭，晚上看书。" * 3, "en"),
    1002: ("Сегодня мы пошли в парк и потом вернулись домой, чтобы поужинать вместе с друзьями.", None),
    1003: (POLISH, None),
    1004: ("aGVsbG8gd29ybGQgdGhpcyBpcyBhIHRlc3Qgb2YgYmFzZTY0IGVuY29kZWQgdGV4dCBxd2xrZWpxd2xrZWpxd2U", "de"),
}


@pytest.fixture(scope="module")
def evidence(spark):
    return langid.document_evidence(spark.read.parquet(f"{SF_DIR}/documents.parquet")).cache()


def test_unseen_trigrams_tell_nothing():
    counts = np.zeros((3, langid.BUCKETS))
    counts[0, :100], counts[1, :10], counts[2, 50:60] = 1000, 5, 70
    shares = langid._shares(counts)
    assert (shares[:, 100:] == shares[0, 100]).all() and (shares[:, 55] != shares[0, 55]).any()


def test_texts_of_no_known_language_are_rejected(spark, evidence):
    made = spark.createDataFrame([(i, t, d, "src0", None) for i, (t, d) in ODD.items()], EVIDENCE)
    found = {r["doc_id"]: r for r in langid.identified(evidence.unionByName(made)).collect()}
    assert [(found[i]["language"], found[i]["kept"]) for i in ODD] == [(None, False)] * len(ODD)
    assert all(r["kept"] and r["language"] == r["declared"] for i, r in found.items() if i not in ODD)


def test_a_language_that_enough_rows_declare_is_known(spark, evidence):
    words = POLISH.split()
    made = [(2000 + i, " ".join(words[i % 9 :] + words[: i % 9]), "pl", f"p{i % 3}.example.pl", "pl") for i in range(120)]
    made += [(3000, POLISH, None, None, None), (3001, "few rows declare this", "xx", None, None)]
    every = evidence.unionByName(spark.createDataFrame(made, EVIDENCE))
    assert langid.declared_languages(every) == ("en", "fr", "de", "es", "pl")
    found = {r["doc_id"]: r for r in langid.identified(every).collect()}
    assert all((found[i]["language"], found[i]["kept"]) == ("pl", True) for i in (*range(2000, 2120), 3000))
