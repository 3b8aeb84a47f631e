"""Every registered query against its SQL on DuckDB, at the smallest scale factor."""

import os

import pytest

import __spark_entry__ as entry_points
from check_queries import compare, oracle_connection

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return oracle_connection(SF)


@pytest.mark.parametrize("name", list(entry_points.queries()))
def test_query(spark, con, name):
    df = entry_points.queries()[name](spark, SF)
    sql = entry_points.oracle_sql().get(name)
    if sql is None:
        assert df.count() > 0
    else:
        assert compare(df, con, sql) is None


def test_entry(spark):
    assert entry_points.entry(spark).count() == 3
