"""Every registered query against its SQL in DuckDB on the smallest test tables."""

import os

import pytest
from compare import connect, difference

import __spark_entry__ as entry

FOLDER = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", list(QUERIES))
def test_equal(spark, con, name):
    df = QUERIES[name](spark, FOLDER)
    if name in SQL:
        assert difference(df, con, SQL[name]) == ""
    else:
        assert df.count() > 0


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["year", "avg_income_exposed", "avg_income_unexposed"]
    assert df.count() > 0
