"""Frequent values are those of the full list; long texts are counted by digest and shown whole."""

import hashlib

from plumbline.operators.frequency import frequent_values, top_values, value_frequencies
from plumbline.operators.report import shown_top_values

LONG = ["a" * 70, "b" * 70, "c" * 70]


def test_long_texts_are_ranked_by_digest_and_shown_whole(spark):
    rows = [(v,) for v in [LONG[0]] * 3 + [LONG[1]] * 3 + [LONG[2], "x", "x", "x", None, None, None, None]]
    tables = {"t": spark.createDataFrame(rows, "v string")}
    found = frequent_values(tables, 4).orderBy("position").collect()
    tied = sorted(LONG[:2], key=lambda v: "#" + hashlib.sha256(v.encode()).hexdigest())
    assert [r["value"] for r in found] == [None, *tied, "x"]
    assert [r["value_count"] for r in found] == [4, 3, 3, 3]
    assert round(found[0]["value_pct"], 6) == round(400 / 14, 6)
    shown = shown_top_values(frequent_values(tables, 4, share=False)).first()
    assert shown["top_values"] == ", ".join(["None", tied[0][:20], tied[1][:20]])


def test_short_values_are_those_of_the_full_list(spark):
    tables = {"t": spark.sql("SELECT CAST(id % 7 AS STRING) AS a, CAST(NULL AS STRING) AS b FROM range(50)")}
    columns = ["table_name", "column_name", "value", "value_count", "position"]
    every = top_values(value_frequencies(tables, share=False), 3).select(*columns).collect()
    assert sorted(map(str, frequent_values(tables, 3, share=False).select(*columns).collect())) == sorted(map(str, every))
