"""Every query against its DuckDB statement."""

import pytest

import __spark_entry__ as entry
from compare import compare, connect
from conftest import SF_DIR
from oracles import ORACLES
from touchline.plans.catalog import QUERIES

SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_a_statement():
    assert set(QUERIES) == set(ORACLES)
    assert set(SQL) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    message, n = compare(spark, con, QUERIES[name], SQL[name], SF_DIR)
    assert message is None
    assert n > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
