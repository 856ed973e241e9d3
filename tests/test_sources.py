import json
import uuid

import pytest
from pyspark.sql import functions as F

from plumbline.plans.rules import read_rules
from plumbline.sources import (
    append_table,
    ensure_namespace,
    export_tables,
    load_table,
    overwrite_partitions,
    read_csv,
    table_inventory,
    work_dir,
    write_csv,
    write_lines,
)
from plumbline.sources import workspace


def test_work_dir_is_below_the_named_folder(spark, monkeypatch):
    class Conf:
        def get(self, key, default=None):
            return "/shared/folder/" if key == workspace.SETTING else default

    class Session:
        conf = Conf()

    path = work_dir(Session(), "x")
    assert path.startswith("/shared/folder/plumbline/x-") and path != work_dir(Session(), "x")


def test_work_dir_refuses_a_cluster_without_shared_folder():
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "yarn"

        def getConf(self):
            return Conf()

    class Session:
        conf = Conf()
        sparkContext = Context()

    with pytest.raises(ValueError):
        work_dir(Session(), "x")


def test_csv_types_are_inferred(spark, tmp_path):
    path = str(tmp_path / "in.csv")
    (tmp_path / "in.csv").write_text("id,amount,name\n1,2.5,a\n2,,b\n")
    df = read_csv(spark, path)
    assert [f.dataType.simpleString() for f in df.schema] == ["int", "double", "string"]
    assert df.where("amount IS NULL").count() == 1


def test_csv_sink_writes_one_file_with_header(spark, tmp_path):
    out = str(tmp_path / "csv")
    write_csv(spark.range(0, 10, numPartitions=4), out)
    files = list((tmp_path / "csv").glob("*.csv"))
    assert len(files) == 1 and files[0].read_text().splitlines()[0] == "id"


def test_lines_keep_their_order(spark, tmp_path):
    lines = spark.range(0, 9, numPartitions=4).selectExpr("9 - id AS line_no", "CAST(9 - id AS STRING) AS line")
    write_lines(lines, str(tmp_path / "text"))
    (file,) = (tmp_path / "text").glob("*.txt")
    assert file.read_text().split() == [str(i) for i in range(1, 10)]


def test_missing_format_falls_back_to_parquet(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(3).write.parquet(path)
    assert load_table(spark, path, table_format="no-such-format").count() == 3


def test_append_creates_then_appends(spark, tmp_path):
    ensure_namespace(spark, "default")
    name, path = f"t_{uuid.uuid4().hex}", str(tmp_path / "t")
    day = spark.range(5).withColumn("ingestion_date", F.lit("2024-01-01"))
    append_table(day, name, path)
    again = append_table(day, name, path)
    assert again.count() == 10 and load_table(spark, name).count() == 10
    spark.sql(f"DROP TABLE {name}")


def test_overwrite_replaces_only_its_days(spark, tmp_path):
    path = str(tmp_path / "t")
    for day, rows in (("2024-01-01", 5), ("2024-01-02", 6), ("2024-01-01", 2)):
        df = overwrite_partitions(spark.range(rows).withColumn("ingestion_date", F.lit(day)), path)
    counts = {str(r.ingestion_date): r["count"] for r in df.groupBy("ingestion_date").count().collect()}
    assert counts == {"2024-01-01": 2, "2024-01-02": 6}


def test_failed_table_does_not_stop_the_export(spark, tmp_path):
    spark.range(4).write.parquet(str(tmp_path / "a"))
    refs = {"gone": str(tmp_path / "gone"), "a": str(tmp_path / "a")}
    rows = {r.table_name: r for r in export_tables(spark, refs, str(tmp_path / "out")).collect()}
    assert (rows["a"].status, rows["a"].record_count) == ("EXPORTED", 4)
    assert (rows["gone"].status, rows["gone"].message) == ("ERROR", "PATH_NOT_FOUND")


def test_inventory_skips_missing_tables(spark, tmp_path):
    spark.range(4).write.parquet(str(tmp_path / "a"))
    refs = {"a": str(tmp_path / "a"), "gone": str(tmp_path / "gone")}
    rows = {r.table_name: (r.table_exists, r.record_count, r.status) for r in table_inventory(spark, refs).collect()}
    assert rows == {"a": (True, 4, "FOUND"), "gone": (False, 0, "SKIPPED")}


def test_rules_are_read_from_a_file(spark, tmp_path):
    path = tmp_path / "rules.json"
    path.write_text(json.dumps({"data_sources": {"s": {"tables": {"t": {"primary_key": ["a", "b"]}}}}}))
    assert read_rules(spark, str(path))["t"].primary_key == ("a", "b")
