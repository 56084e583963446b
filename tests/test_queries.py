"""Every registered query against its SQL in DuckDB."""

import pytest

import __spark_entry__ as contract
from orderlake import queries as registered
from oracle import connect, in_duckdb, in_spark


@pytest.fixture(scope="module")
def connection(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", registered.QUERIES)
def test_query_equals_its_sql(spark, connection, sf_dir, name):
    ours = in_spark(contract.queries()[name](spark, sf_dir))
    theirs = in_duckdb(connection, contract.oracle_sql()[name])
    assert ours[0] == theirs[0]
    assert ours[1] == theirs[1]


def test_entry(spark):
    assert contract.entry(spark).count() > 0
