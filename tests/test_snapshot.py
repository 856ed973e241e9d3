import pytest
from pyspark.sql import functions as F

from plumbline.functions import METADATA_COLUMNS, business_columns
from plumbline.operators import snapshot


def ids(df):
    return sorted(r.id for r in df.collect())


def test_hash_sample_does_not_depend_on_partitions(spark):
    df = spark.range(20000)
    one = ids(snapshot.hash_sample(df, "id", "2024-01-01", 0.02))
    assert one == ids(snapshot.hash_sample(df.repartition(7), "id", "2024-01-01", 0.02))
    assert 300 < len(one) < 500
    assert one != ids(snapshot.hash_sample(df, "id", "2024-01-02", 0.02))


@pytest.mark.parametrize("fraction, rows", [(0.0, 0), (1.0, 100)])
def test_limits_of_the_fraction(spark, fraction, rows):
    assert snapshot.hash_sample(spark.range(100), "id", "2024-01-01", fraction).count() == rows


def test_row_sample(spark):
    df = spark.range(0, 20000, numPartitions=4)
    first, second = (ids(snapshot.bernoulli_sample(df, 0.05, 42)) for _ in range(2))
    assert first == second and 800 < len(first) < 1200 and len(set(first)) == len(first)


def test_seed_and_fraction_follow_from_the_date():
    assert snapshot.run_seed("2024-01-01") == snapshot.run_seed("2024-01-01")
    assert snapshot.run_seed("2024-01-01") != snapshot.run_seed("2024-01-02")
    for day in range(1, 29):
        assert 0.015 <= snapshot.run_fraction(f"2024-01-{day:02d}") <= 0.025
        assert 0.05 <= snapshot.run_fraction(f"2024-01-{day:02d}", 0.05, 0.15) <= 0.15


def test_live_stamp_has_six_columns(spark):
    daily = snapshot.stamp_run(spark.range(3), "2024-01-01", "20240101_000000")
    assert daily.columns == ["id", *METADATA_COLUMNS]
    assert business_columns(daily).columns == ["id"]
    assert len({r.batch_id for r in daily.collect()}) == 3


def test_older_stamp_labels_the_batch(spark):
    row = snapshot.stamp_metadata(spark.range(1), "bureau", "2024-01-01", as_of="2024-01-01").first()
    assert (row.batch_id, row.data_source) == ("bureau_batch_2024-01-01", "daily_simulation")


def test_row_ids_are_unique(spark):
    rows = snapshot.row_ids(spark.range(0, 1000, numPartitions=5))
    assert rows.select("row_id").distinct().count() == 1000


@pytest.mark.parametrize("key", [None, "id"])
def test_jitter_stays_in_its_bounds(spark, key):
    df = spark.range(2000).withColumn("amount", F.lit(100.0)).withColumn("other", F.lit(1))
    changed = snapshot.jitter(df, {"amount": 0.1, "absent": 0.5}, key=key, seed=5)
    assert changed.columns == df.columns
    low, high = changed.agg(F.min("amount"), F.max("amount")).first()
    assert 95.0 <= low < 95.5 and 104.5 < high <= 105.0
    assert snapshot.jitter(df, {"absent": 0.5}).columns == df.columns


def test_backfill_equals_the_samples_of_its_days(spark):
    df = spark.range(5000)
    days = snapshot.backfill(df, "t", "id", "2024-01-10", days=3, fraction=0.02)
    found = {}
    for row in days.collect():
        found.setdefault(row.ingestion_date, []).append(row.id)
    assert sorted(found) == ["2024-01-07", "2024-01-08", "2024-01-09"]
    for day, taken in found.items():
        assert sorted(taken) == ids(snapshot.hash_sample(df, "id", day, 0.02))


def test_summary(spark):
    rows = [("a", "success", 10), ("b", "error", None), ("c", "success", 5)]
    results = spark.createDataFrame(rows, "table_name string, status string, record_count bigint")
    row = snapshot.snapshot_summary(results).first()
    assert (row.total_records, row.successful_tables, row.total_tables, row.success_rate) == (15, 2, 3, 66.7)


def test_fixed_tables_cover_the_loan_tables():
    assert len(snapshot.LOAN_SAMPLE_RATES) == 8
    assert snapshot.JITTER_WIDTHS["credit_card"] == {"AMT_BALANCE": 0.15}


def test_rows_without_part_of_the_key_are_told_apart(spark):
    df = spark.range(4000).selectExpr("id", "CAST(NULL AS INT) AS part")
    taken = snapshot.hash_sample(df, ["part", "id"], "2024-01-01", 0.1).count()
    assert 300 < taken < 500
