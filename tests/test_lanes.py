import pytest

from plumbline.plans.checking import run_checks, stored_run
from plumbline.plans.policy import Range, TableRules
from plumbline.sources import csv_schema
from plumbline.sources.lanes import read_lanes
from tests.test_checking import csv_rows

SF_DIR = "/root/testdata/sf0.001"


def write(tmp_path, text, name="t.csv"):
    path = tmp_path / name
    path.write_text(text)
    return str(path)


def test_broken_lines_are_kept_aside(spark, tmp_path):
    path = write(tmp_path, 'k,v,d\n1,2.5,2024-01-01\n2,broken\n3,"a, b",2024-01-02\n4,5,6,7\n,,\n')
    good, broken = read_lanes(spark, path)
    assert [tuple(map(str, r)) for r in good.collect()] == [("1", "2.5", "2024-01-01"), ("3", "a, b", "2024-01-02"), ("None", "None", "None")]
    rows = {r.record: (r.file.rsplit("/", 1)[-1], r.n_values) for r in broken.collect()}
    assert rows == {"2,broken": ("t.csv", 2), "4,5,6,7": ("t.csv", 3)}
    assert [t for _, t in good.dtypes] == ["int", "string", "date"]
    # The same rows are broken whichever columns are asked for.
    assert good.select("k").count() == 3 and broken.count() == 2


@pytest.mark.parametrize("table", ["customer", "part", "orders", "lineitem", "events", "nation"])
def test_types_are_those_that_spark_infers(spark, tmp_path, table):
    path = str(tmp_path / f"{table}.csv")
    spark.read.parquet(f"{SF_DIR}/{table}.parquet").write.option("header", True).csv(path)
    good, broken = read_lanes(spark, path)
    assert {f.name: f.dataType for f in good.schema} == {f.name: f.dataType for f in csv_schema(spark, path)}
    assert broken.isEmpty() and good.count() == spark.read.parquet(f"{SF_DIR}/{table}.parquet").count()


def test_types_of_odd_columns(spark, tmp_path):
    lines = ["a,b,c,d,e,f,g", "1,3000000000,1,true,2024-01-01,,x", "-7,2,1.5,FALSE,2024-01-01 10:20:30,,1", "+0,,1e5,,,,2024-01-01"]
    path = write(tmp_path, "\n".join(lines) + "\n")
    good, _ = read_lanes(spark, path)
    assert [t for _, t in good.dtypes] == [t.simpleString() for t in (f.dataType for f in csv_schema(spark, path))]
    assert [t for _, t in good.dtypes] == ["int", "bigint", "double", "boolean", "timestamp", "string", "string"]


def test_a_run_judges_the_other_lines(spark, tmp_path):
    path = write(tmp_path, "k,v\n1,2\n3\n4,5\n")
    rules = {"t": TableRules(volume=Range(2, 2), freshness_hours=None)}
    paths = run_checks(spark, {"t": path}, rules, str(tmp_path / "out"), "1", "2024-01-01")
    found = {r.check_type: (r.status, r.actual, r.message) for r in stored_run(spark, paths).collect()}
    assert found["volume"] == ("PASS", 2.0, None)
    assert found["malformed_rows"] == ("ERROR", 1.0, "1 lines that do not fit the header")
    assert [r.overall_status for r in csv_rows(spark, paths["tables"])] == ["ERROR"]
    assert [r.record for r in spark.read.parquet(f"{paths['malformed']}/source=t").collect()] == ["3"]
