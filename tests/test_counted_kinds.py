"""Counted values of columns of some kinds only."""

import datetime
import re

from plumbline.operators.profile import column_profile
from plumbline.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def test_figures_of_numbers_need_no_texts(spark):
    rows = [(1, 0.5, "a", datetime.date(2024, 1, 1)), (1, None, "b", None), (None, -2.0, None, None)]
    df = spark.createDataFrame(rows, "a long, b double, c string, d date")
    every = [r for r in column_profile(df, "t").collect() if r["kind"] == "numeric"]
    numbers = column_profile(df, "t", kinds=["numeric"])
    assert {str(r) for r in numbers.collect()} == {str(r) for r in every} and len(every) == 2
    keys = re.findall(r"keys=\[([^\]]*)", numbers._jdf.queryExecution().executedPlan().toString())
    assert any("v_double" in k for k in keys) and not any("v_text" in k for k in keys)
    texts = column_profile(df, "t", kinds=["string", "other"]).collect()
    others = [r for r in column_profile(df, "t").collect() if r["kind"] != "numeric"]
    assert {str(r) for r in texts} == {str(r) for r in others} and len(others) == 2


def test_the_deviation_is_counted_without_texts(spark):
    plan = QUERIES["profile_stddev_exact"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "l_quantity" in plan and "l_shipdate" not in plan and "html" not in plan
