"""Checks across rows and tables against brute force, with one key in a third of all rows."""

from collections import Counter, defaultdict

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from plumbline.operators.integrity import (
    date_order_check,
    orphan_rows,
    primary_key_check,
    reference_check,
    sequence_check,
    sequence_gaps,
)
from plumbline.operators.skew import hot_keys, salted_join


def skewed(n=900):
    """Keys 0 to 99, of which key 7 holds a third of all rows, and some nulls."""
    return [(7 if i % 3 == 0 else None if i % 50 == 1 else i % 100, i) for i in range(n)]


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("share", [0.001, 0.2, 2.0])
def test_salted_join_equals_plain_join(spark, how, share):
    left = spark.createDataFrame(skewed(), "k int, v int")
    right = spark.createDataFrame([(k, f"p{k}") for k in range(0, 80)] + [(3, "again"), (None, "n")], "k int, w string")
    plain = left.join(right, ["k"], how)
    salted = salted_join(left, right, ["k"], ["v"], how, share=share, salts=4)
    assert salted.columns == plain.columns
    assert Counter(map(tuple, salted.collect())) == Counter(map(tuple, plain.collect()))


def test_salting_spreads_the_hot_key(spark):
    left = spark.createDataFrame(skewed(), "k int, v int")
    right = spark.createDataFrame([(k, k) for k in range(100)], "k int, w int")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = salted_join(left, right, ["k"], ["v"], share=0.1, salts=64).where("k = 7")
        parts = joined.selectExpr("spark_partition_id() AS p").groupBy("p").count().collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    assert len(parts) >= 6 and max(r["count"] for r in parts) < 150


def test_salted_join_refuses_joins_that_show_the_copies(spark):
    df = spark.createDataFrame([(1, 1)], "k int, v int")
    with pytest.raises(ValueError):
        salted_join(df, df, ["k"], ["v"], "outer")


def test_hot_keys_are_few(spark):
    df = spark.createDataFrame(skewed(), "k int, v int")
    assert [r.k for r in hot_keys(df, ["k"], 0.1).collect()] == [7]


def test_primary_key(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (1, 2), (None, 1), (None, 1)], "a int, b int")
    row = primary_key_check(df, "t", ["a", "b"]).first()
    assert (row.total_rows, row.distinct_keys, row.duplicate_keys, row.duplicate_rows, row.status) == (
        5,
        3,
        2,
        4,
        "FAIL",
    )
    empty = primary_key_check(df.limit(0), "t", ["a"]).first()
    assert (empty.total_rows, empty.duplicate_rows, empty.status) == (0, 0, "PASS")


def test_references(spark):
    child = spark.createDataFrame(skewed(), "k int, v int")
    parent = spark.createDataFrame([(k,) for k in range(50) if k != 7] * 2, "id int")
    known = set(range(50)) - {7}
    values = [k for k, _ in skewed() if k is not None]
    orphans = Counter(k for k in values if k not in known)
    row = reference_check(child, "k", parent, "id", "c", "p").first()
    assert (row.checked_rows, row.orphan_rows, row.orphan_keys) == (
        len(values),
        sum(orphans.values()),
        len(orphans),
    )
    listed = {r.key_value: r.row_count for r in orphan_rows(child, "k", parent, "id").collect()}
    assert listed == dict(orphans)


def test_date_order(spark):
    child = spark.createDataFrame(skewed(), "k int, v int")
    parent = spark.createDataFrame([(k, 400 if k == 7 else 100) for k in range(90)], "id int, start int")
    start = {k: 400 if k == 7 else 100 for k in range(90)}
    pairs = [(k, v) for k, v in skewed() if k in start]
    row = date_order_check(child, parent, ("k", "id"), "v", "start", "c").first()
    assert row.checked_rows == len(pairs)
    assert row.violations == sum(v < start[k] for k, v in pairs)


@settings(
    max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(st.lists(st.tuples(st.sampled_from("abc"), st.integers(-5, 12)), min_size=1, max_size=40))
def test_gaps_equal_brute_force(spark, rows):
    groups = defaultdict(set)
    for key, number in rows:
        groups[key].add(number)
    expected = {}
    for key, numbers in groups.items():
        ordered = sorted(numbers)
        steps = [b - a for a, b in zip(ordered, ordered[1:])]
        expected[key] = (sum(s > 1 for s in steps), sum(s - 1 for s in steps))
    df = spark.createDataFrame(rows, "g string, n int")
    found = {r.group_key: (r.gaps, r.missing_numbers) for r in sequence_gaps(df, "n", "g").collect()}
    assert found == expected


def test_one_sequence_over_the_whole_table(spark):
    df = spark.createDataFrame([(1,), (2,), (2,), (5,), (None,)], "n int")
    row = sequence_check(df, "t", "n").first()
    assert (row.sequences, row.gaps, row.missing_numbers, row.status) == (1, 1, 2, "FAIL")
