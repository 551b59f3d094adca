"""Every registered query against its SQL on the smallest tables."""

import pytest
from conftest import SF_DIR

import __spark_entry__ as contract
from checks import oracle, queries
from checks.compare import difference, duck

# the library's own queries; corpus operators, which SQL mostly cannot express, are tested in tests/llm
QUERIES, SQL = queries.queries(), oracle.oracle_sql()


@pytest.fixture(scope="module")
def connection():
    return duck(SF_DIR)


def test_every_query_has_sql():
    assert QUERIES.keys() == SQL.keys()
    assert QUERIES.keys() <= contract.queries().keys() and SQL.keys() <= contract.oracle_sql().keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, connection, name):
    got = QUERIES[name](spark, SF_DIR).toPandas()
    assert difference(got, connection.execute(SQL[name]).df()) is None


def test_entry(spark):
    df = contract.entry(spark)
    assert df.count() == 30 and "overall_completion_rate" in df.columns
