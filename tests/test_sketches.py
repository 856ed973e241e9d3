import math

from pyspark.sql import functions as F

from plumbline.operators import sketches

SCHEMA = "run string, n bigint, x double, word string, day date, odd map<int,int>"


def rows(spark, n=60_000):
    return spark.range(n).selectExpr(
        "CAST(id % 30 AS STRING) AS run", "CASE WHEN id % 10 > 0 THEN id % 7919 END AS n", "(id * 7919 % 100003) / 10 AS x",
        "concat('w', id % 500) AS word", "date_add(DATE '2024-01-01', CAST(id % 40 AS INT)) AS day", "map(1, 2) AS odd",
    )


def test_thirty_runs_merge_to_what_one_scan_gives(spark, tmp_path):
    df, path = rows(spark), str(tmp_path / "sketches")
    sketches.column_sketches(df, "t", by="run").write.parquet(path)
    stored = spark.read.parquet(path)
    assert stored.count() == 30 * 5
    found = {r.column_name: r for r in sketches.estimated(sketches.merged(stored, "table_name"), (0.01, 0.5, 0.99)).collect()}
    bound = 3 * sketches.DISTINCT_ERROR
    for column in ("n", "x", "word", "day"):
        exact = df.select(column).distinct().count()
        assert abs(found[column].distinct_count - exact) <= max(1, bound * exact)
        assert found[column].total_rows == 60_000
    assert (found["n"].null_count, found["n"].min_num, found["n"].max_num) == (6000, 0.0, 7918.0)
    assert found["odd"].distinct_count is None and found["word"].quantiles is None
    for rank, value in zip((0.01, 0.5, 0.99), found["x"].quantiles):
        assert abs(df.where(F.col("x") <= value).count() / 60_000 - rank) <= sketches.RANK_ERROR
    low, high = df.approxQuantile("x", [0.25, 0.75], 0)
    width = 1.5 * (high - low)
    assert math.isclose(found["x"].outliers_above, high + width, rel_tol=0.1)


def test_days_without_values(spark):
    odd = spark.createDataFrame(
        [("a", None, None, None, None, None), ("a", None, float("nan"), None, None, None), ("b", 1, -0.0, "", None, {1: 2}), ("b", 1, 0.0, "", None, None)], SCHEMA
    )
    found = {r.column_name: r for r in sketches.estimated(sketches.merged(sketches.column_sketches(odd, "t", by="run"), "table_name")).collect()}
    assert (found["n"].distinct_count, found["day"].distinct_count, found["day"].uniqueness_pct) == (2, None, None)
    # NaN, zero and null.
    assert found["x"].distinct_count == 3 and list(found["x"].quantiles) == [0.0, 0.0, 0.0]
    empty = sketches.estimated(sketches.column_sketches(odd.limit(0), "t")).collect()
    assert {r.total_rows for r in empty} == {0} and all(r.distinct_count is None for r in empty)
