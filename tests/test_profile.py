import datetime
import decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from plumbline.operators import outliers as outliers_module
from plumbline.operators import profile as profile_module
from plumbline.operators.outliers import outlier_counts, zscore_rows
from plumbline.operators.profile import column_profile, profile_long, profile_tables


def by_column(profile):
    return {row.column_name: row for row in profile.collect()}


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, NaN, both zeros, blanks, a constant and every kind of type."""
    day, moment = datetime.date(2024, 1, 1), datetime.datetime(2024, 1, 1, 12, 30, 5, 17)
    rows = [
        (1, 0.0, "", 7, None, True, decimal.Decimal("1.50"), day, moment, moment, [1.0], b"a", {"k": 1}),
        (2, -0.0, " ", 7, None, None, decimal.Decimal("-2.25"), day, moment, moment, [1.0], b"a", None),
        (2, float("nan"), "  ", 7, None, False, None, None, None, None, None, None, {"k": 2}),
        (None, None, "x" * 70, 7, None, True, None, None, None, None, [2.0, 3.0], b"b", {}),
        (-5, 2.5, "x" * 70, 7, None, True, None, None, None, None, [2.0, 3.0], b"b", {}),
        (9, 2.5, None, 7, None, True, None, None, None, None, [], b"", {}),
    ]
    schema = (
        "id bigint, d double, s string, k int, gone string, flag boolean, dec decimal(10,2), day date, "
        "at timestamp, local timestamp_ntz, list array<double>, raw binary, m map<string,int>"
    )
    return spark.createDataFrame(rows, schema)


def test_nulls_and_distinct_values_count_null_once(odd):
    found = by_column(column_profile(odd, "odd"))
    assert [found[c].null_count for c in ("id", "d", "s", "gone", "m")] == [1, 1, 1, 6, 1]
    assert found["id"].distinct_count == 5  # 1, 2, -5, 9 and null
    assert found["d"].distinct_count == 4  # both zeros are one value; NaN, 2.5 and null
    assert found["s"].distinct_count == 5
    assert found["flag"].distinct_count == 3
    assert found["dec"].distinct_count == 3
    assert found["day"].distinct_count == found["at"].distinct_count == found["local"].distinct_count == 2
    assert found["list"].distinct_count == 4
    assert found["raw"].distinct_count == 4
    assert found["k"].distinct_count == 1


def test_column_without_values_is_not_judged_for_uniqueness(odd):
    gone = by_column(column_profile(odd, "odd"))["gone"]
    assert (gone.null_pct, gone.distinct_count, gone.uniqueness_pct) == (100.0, None, None)
    assert (gone.min_len, gone.max_len, gone.avg_len) == (None, None, None)


def test_map_has_no_distinct_count(odd):
    m = by_column(column_profile(odd, "odd"))["m"]
    assert (m.null_count, m.distinct_count) == (1, None)


def test_nan_is_no_null_and_the_greatest_value(odd):
    d = by_column(column_profile(odd, "odd"))["d"]
    assert d.non_null_count == 5 and d.min_num == 0.0 and d.max_num != d.max_num


def test_blank_is_empty_or_one_space(odd):
    s = by_column(column_profile(odd, "odd"))["s"]
    assert (s.blank_count, s.min_len, s.max_len) == (2, 0, 70)


def test_only_numeric_types_have_figures(odd):
    found = by_column(column_profile(odd, "odd"))
    assert {c for c, row in found.items() if row.kind == "numeric"} == {"id", "d", "k", "dec"}
    assert (found["id"].min_num, found["id"].max_num, found["id"].negative_count) == (-5.0, 9.0, 1)
    assert (found["dec"].min_num, found["dec"].mean, found["dec"].negative_count) == (-2.25, -0.375, 1)
    assert found["at"].min_num is None


@pytest.mark.parametrize("distinct, widest", [("approx", 300), ("none", 300), ("none", 0)])
def test_all_plans_agree(odd, monkeypatch, distinct, widest):
    monkeypatch.setattr(profile_module, "WIDEST_AGGREGATE", widest)
    exact = by_column(column_profile(odd, "odd"))
    other = by_column(column_profile(odd, "odd", distinct=distinct))
    skipped = {"stddev", "distinct_count", "uniqueness_pct"} if distinct == "none" else {"stddev"}
    for name, row in exact.items():
        for field in set(row.asDict()) - skipped:
            assert str(other[name][field]) == str(row[field]), (name, field)


@pytest.mark.parametrize("distinct", ["exact", "approx", "none"])
def test_empty_table_keeps_its_columns(odd, distinct):
    found = by_column(column_profile(odd.limit(0), "empty", distinct=distinct))
    assert len(found) == 13
    assert all((r.total_rows, r.null_count, r.null_pct) == (0, 0, 0.0) for r in found.values())
    assert all(r.distinct_count is None and r.min_num is None for r in found.values())


def test_sums_of_counts(odd):
    for row in column_profile(odd, "odd").collect():
        assert row.null_count + row.non_null_count == row.total_rows
        if row.distinct_count is not None:
            assert row.distinct_count <= row.total_rows


def test_time_stamps_that_share_an_instant_in_a_zone_stay_apart(spark):
    """02:30 does not exist on that night in Berlin; without a zone it is a time like any other."""
    df = spark.sql(
        "SELECT * FROM VALUES (TIMESTAMP_NTZ'2024-03-31 02:30:00'), (TIMESTAMP_NTZ'2024-03-31 03:30:00'), "
        "(TIMESTAMP_NTZ'1969-12-31 23:59:59.999999'), (TIMESTAMP_NTZ'1970-01-01 00:00:00') AS t(at)"
    )
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        assert by_column(column_profile(df, "t"))["at"].distinct_count == 4
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_long_text_and_its_digest_look_alike_are_two_values(spark):
    long = "y" * 100
    df = spark.createDataFrame([(long,), (long,)], "s string")
    lookalike = df.select(F.concat(F.lit("#"), F.sha2("s", 256)).alias("s"))
    found = by_column(column_profile(df.union(lookalike), "t"))["s"]
    assert found.distinct_count == 2 and found.total_rows == 4


def test_awkward_column_names(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b")], "`a.b` int, `it's ``quoted`` \\\\` string")
    found = by_column(column_profile(df, "it's"))
    assert set(found) == set(df.columns)
    assert found["a.b"].null_count == 1
    assert {r.column_name for r in column_profile(df, "it's", distinct="none").collect()} == set(df.columns)


def test_runs_are_profiled_apart(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("a", None), ("b", 4)], "run string, v int")
    for distinct in ("exact", "approx", "none"):
        rows = {r.run_id: r for r in column_profile(df, "t", by="run", distinct=distinct).collect()}
        assert (rows["a"].total_rows, rows["a"].null_count, rows["a"].mean) == (3, 1, 1.0)
        assert (rows["b"].total_rows, rows["b"].null_count, rows["b"].mean) == (1, 0, 4.0)


def test_wide_table(spark):
    df = spark.range(50).select(*[(F.col("id") % (i + 1)).alias(f"c{i}") for i in range(339)])
    for distinct in ("exact", "none"):
        found = by_column(column_profile(df, "wide", distinct=distinct))
        assert len(found) == 339
        assert found["c338"].max_num == 49.0 and found["c4"].max_num == 4.0
    assert by_column(column_profile(df, "wide"))["c4"].distinct_count == 5
    assert column_profile(df, "wide", max_columns=10).count() == 10
    assert column_profile(df, "wide", named="^c1$").count() == 1


def test_spread_agrees_between_plans(spark, monkeypatch):
    df = spark.createDataFrame([(1.0, 5), (2.0, None), (4.0, 9)], "d double, i int")
    one = {c: r.stddev for c, r in by_column(column_profile(df, "t", distinct="none")).items()}
    monkeypatch.setattr(profile_module, "WIDEST_AGGREGATE", 0)
    other = {c: r.stddev for c, r in by_column(column_profile(df, "t", distinct="none")).items()}
    assert one == pytest.approx(other) and one["i"] == pytest.approx(8**0.5)


def test_several_tables_keep_apart(spark):
    one = spark.createDataFrame([(1,), (2,)], "v int")
    two = spark.createDataFrame([(2,), (2,), (None,)], "v int")
    rows = {r.table_name: r for r in profile_tables({"one": one, "two": two}).collect()}
    assert (rows["one"].distinct_count, rows["two"].distinct_count) == (2, 2)
    assert (rows["one"].total_rows, rows["two"].total_rows) == (2, 3)


def test_metadata_columns_are_left_out(spark):
    df = spark.createDataFrame([(1, "2024-01-01")], "v int, ingestion_date string")
    assert [r.column_name for r in column_profile(df, "t").collect()] == ["v"]


def test_long_form_leaves_out_missing_statistics(spark):
    df = spark.createDataFrame([("a",)], "s string")
    stats = {r.stat for r in profile_long(column_profile(df, "t")).collect()}
    assert "max_len" in stats and "mean" not in stats


def test_outliers_also_around_a_mean_of_zero(spark):
    values = [0.0] * 98 + [50.0, -50.0]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert outlier_counts(df, "t").first().outlier_count == 2
    assert {r.v for r in zscore_rows(df, "v").collect()} == {50.0, -50.0}


def test_outliers_of_wide_tables(spark, monkeypatch):
    df = spark.range(300).selectExpr("id", "CASE WHEN id = 7 THEN 1e6 END AS one", "pow(id, 6) AS far", "'x' AS s")
    narrow = sorted(map(tuple, outlier_counts(df, "t", 2.0).collect()))
    monkeypatch.setattr(outliers_module, "WIDEST_SPREAD", 0)
    wide = sorted(map(tuple, outlier_counts(df, "t", 2.0).collect()))
    assert [(r[1], r[4]) for r in wide] == [(r[1], r[4]) for r in narrow]
    assert dict((r[1], r[4]) for r in wide)["far"] > 0 and len(wide) == 3


def test_constant_column_has_no_outliers(spark):
    df = spark.createDataFrame([(1.0,)] * 5, "v double")
    assert outlier_counts(df, "t").first().outlier_count == 0
    assert zscore_rows(df, "v").count() == 0




@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(
            st.one_of(st.none(), st.integers(-3, 3), st.integers(-(2**62), 2**62)),
            st.one_of(st.none(), st.floats(-5, 5), st.sampled_from([0.0, -0.0, 1.5])),
            st.one_of(st.none(), st.text("ab #", max_size=3), st.text("xyz", min_size=66, max_size=70)),
        ),
        min_size=1,
        max_size=30,
    )
)
def test_profile_equals_brute_force(spark, rows):
    found = by_column(column_profile(spark.createDataFrame(rows, "i bigint, d double, s string"), "t"))
    for name, values in zip("ids", zip(*rows)):
        present = [v for v in values if v is not None]
        row = found[name]
        assert (row.total_rows, row.null_count) == (len(values), len(values) - len(present))
        if not present:
            assert row.distinct_count is None and row.min_num is None and row.max_len is None
            continue
        assert row.distinct_count == len(set(values))
        if name == "s":
            lengths = [len(v) for v in present]
            assert (row.min_len, row.max_len) == (min(lengths), max(lengths))
            assert row.avg_len == pytest.approx(sum(lengths) / len(lengths))
            assert row.blank_count == sum(v in ("", " ") for v in present)
        else:
            assert (row.min_num, row.max_num) == (float(min(present)), float(max(present)))
            assert row.mean == pytest.approx(sum(present) / len(present), abs=1e-6, rel=1e-9)
            assert row.negative_count == sum(v < 0 for v in present)
