"""Every registered query against its SQL, over all rows of the smallest tables."""

import pytest

import __spark_entry__ as contract
from tests.conftest import SMALL
from verification.compare import connect, difference
from verification.profile_sql import structured
from verification.tables import TABLES

#: The queries of the library itself; those for training data have tests of their own.
QUERIES = {name: f for name, f in contract.queries().items() if name in contract.library()}
SQL = {name: sql for name, sql in contract.oracle_sql().items() if name in QUERIES}


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, con, name):
    assert difference(QUERIES[name](spark, SMALL), con, SQL[name]) is None


def test_entry(spark):
    columns = sum(len(structured(t)) for t in TABLES)
    assert contract.entry(spark).count() == columns
