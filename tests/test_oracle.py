"""Every query with SQL gives the same rows as DuckDB."""

import pytest

from plumbline.queries import ORACLES, QUERIES
from tests.compare import difference, duck

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_sql(spark, connection, name):
    assert difference(spark, connection, name, SF_DIR) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_sql_has_rows(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0


def test_every_sql_belongs_to_a_query():
    assert set(ORACLES) <= set(QUERIES)
