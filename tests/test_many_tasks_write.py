"""What queries write in between is written by the tasks that read it, not by one."""

import glob

import pytest

from plumbline.queries import QUERIES, declared, runs

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture
def parts_of(spark, tmp_path):
    """A folder with a table dealt over several files."""

    def dealt(name):
        rows = spark.read.parquet(f"{SF_DIR}/{name}.parquet")
        rows.repartition(4).write.parquet(f"{tmp_path}/data/{name}.parquet")
        return f"{tmp_path}/data"

    return dealt


def labelled(monkeypatch, module, tmp_path):
    monkeypatch.setattr(module, "work_dir", lambda spark, label: f"{tmp_path}/work/{label}")


def rows_of(frame):
    return sorted(map(str, frame.collect()))


def test_lines_are_written_by_many_tasks(spark, tmp_path, monkeypatch, parts_of):
    want = rows_of(QUERIES["malformed_rows"](spark, SF_DIR))
    data = parts_of("orders")
    labelled(monkeypatch, runs, tmp_path)
    assert rows_of(QUERIES["malformed_rows"](spark, data)) == want
    files = glob.glob(f"{tmp_path}/work/lanes.csv/part-*")
    assert len(files) == 4
    for file in files:
        with open(file) as lines:
            head, *others = lines.read().splitlines()
        assert head == "key,cust,status,price,day" and others and not any('"' in x for x in others)


def test_arrivals_are_written_by_many_tasks(spark, tmp_path, monkeypatch, parts_of):
    want = rows_of(QUERIES["watch_rules"](spark, SF_DIR))
    data = parts_of("events")
    labelled(monkeypatch, declared, tmp_path)
    assert rows_of(QUERIES["watch_rules"](spark, data)) == want
    assert len(glob.glob(f"{tmp_path}/work/watched/part-*")) == 12
    assert len(glob.glob(f"{tmp_path}/work/watch/events/buffers/batch=*")) == 3
