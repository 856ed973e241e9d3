"""The code's length is held against what was coded, so white space that is not coded does not count."""

import pytest

from plumbline.llm import scoring


def test_wider_blanks_change_no_score(spark):
    words = "the old town by the sea has a wall and a harbour".split()
    rows = [(i, " ".join(words)) for i in range(1, 5)] + [(5, ("  \t  ").join(words)), (6, ""), (7, None)]
    found = {r["doc_id"]: r for r in scoring.scored(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found[5]["score"] == pytest.approx(found[1]["score"])
    assert found[5]["bits_per_byte"] == pytest.approx(found[1]["bits_per_byte"])
    # An empty text is one coded byte, the end.
    assert found[6]["bits_per_byte"] == found[7]["bits_per_byte"] > 0
