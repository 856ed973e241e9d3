import pytest
from pyspark.sql import functions as F

from plumbline.plans import publishing
from plumbline.plans.checking import run_checks, stored_run
from plumbline.plans.policy import TableRules
from plumbline.plans.publishing import ACCEPTED, REJECTED, AuditFailed, publish, published, read_manifest, rejected_by


def rows(spark, n=100):
    return spark.range(n).selectExpr(
        "id", "CASE WHEN id % 3 > 0 THEN id END AS a", "CASE WHEN id % 5 > 0 THEN 'x' END AS `b c`", "1 AS verdicts"
    )


def test_both_halves_add_up_and_say_why(spark, tmp_path):
    out = str(tmp_path)
    manifest = publish(rows(spark), ["a", "b c"], out, "20240101")
    accepted, rejected = published(spark, out, "20240101"), published(spark, out, "20240101", REJECTED)
    assert (manifest[ACCEPTED], manifest[REJECTED]) == (accepted.count(), rejected.count()) == (53, 47)
    assert accepted.columns == ["id", "a", "b c", "verdicts"]
    assert accepted.union(rejected.drop("reasons")).exceptAll(rows(spark)).isEmpty()
    found = {(r.reasons, r.null_columns): r.row_count for r in rejected_by(rejected, ["a", "b c"]).collect()}
    assert found == {(1, "a"): 27, (2, "b c"): 13, (3, "a, b c"): 7}


def test_nothing_is_seen_before_it_is_published(spark, tmp_path, monkeypatch):
    out = str(tmp_path)

    def lost(*_):
        raise ConnectionError("lost between write and publish")

    with monkeypatch.context() as patch:
        patch.setattr(publishing, "_publish", lost)
        with pytest.raises(ConnectionError):
            publish(rows(spark), ["a"], out, "20240101")
    assert len(list((tmp_path / "data" / "day=20240101").iterdir())) == 1
    assert read_manifest(spark, out, "20240101") is None and published(spark, out, "20240101") is None
    first = publish(rows(spark), ["a"], out, "20240101")
    again = publish(rows(spark, 7), ["a"], out, "20240101")
    # The day is published once, and the lost attempt is no part of it.
    assert again == first and published(spark, out, "20240101").count() == 66
    assert len(list((tmp_path / "data" / "day=20240101").iterdir())) == 2


def test_the_first_of_two_attempts_stands(spark, tmp_path):
    out = str(tmp_path)
    first = publishing._publish(spark, out, "d", {"day": "d", "path": "one", ACCEPTED: 1, REJECTED: 0})
    second = publishing._publish(spark, out, "d", {"day": "d", "path": "two", ACCEPTED: 2, REJECTED: 0})
    assert first == second == read_manifest(spark, out, "d") and first["path"] == "one"
    assert list((tmp_path / "drafts").glob("*.json")) == []


def test_counts_that_do_not_add_up_publish_nothing(spark, tmp_path, monkeypatch):
    out, write = str(tmp_path), publishing._write
    monkeypatch.setattr(publishing, "_write", lambda *args: write(*args) + 1)
    with pytest.raises(AuditFailed):
        publish(rows(spark), ["a"], out, "20240101")
    assert read_manifest(spark, out, "20240101") is None


def test_empty_tables_and_whole_halves(spark, tmp_path):
    out = str(tmp_path)
    assert publish(rows(spark).limit(0), ["a"], out, "0")[ACCEPTED] == 0
    assert published(spark, out, "0") is None and published(spark, out, "0", REJECTED) is None
    assert publish(rows(spark), [], out, "1")[ACCEPTED] == 100
    nothing = rows(spark).withColumn("a", F.lit(None).cast("int"))
    assert publish(nothing, ["a"], out, "2") | {"path": ""} == {"day": "2", "path": "", "columns": ["a"], ACCEPTED: 0, REJECTED: 100}


def test_a_rule_run_splits_the_rows_of_its_tables(spark, tmp_path):
    path, out = str(tmp_path / "t"), str(tmp_path / "out")
    rows(spark).write.parquet(path)
    rules = {"t": TableRules(critical=("A", "absent"), freshness_hours=None), "free": TableRules(freshness_hours=None)}
    paths = run_checks(spark, {"t": path, "free": path}, rules, out, "20240101_000000", "2024-01-01", split_rows=True)
    assert published(spark, f"{out}/rows/t", "20240101_000000").count() == 66
    assert not (tmp_path / "out" / "rows" / "free").exists()
    assert stored_run(spark, paths).where("status = 'ERROR'").isEmpty()
