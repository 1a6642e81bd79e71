"""Every registered query against its SQL on the smallest test tables."""

import os

import catalog.oracles
import catalog.oracles_more
import catalog.queries
import catalog.queries_more
import pytest
from oracle_compare import compare, connect

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
# The catalog's own; what else the entry adds has tests of its own.
QUERIES, EXPECTED = catalog.queries.QUERIES, catalog.oracles.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_all_have_sql():
    assert set(QUERIES) == set(EXPECTED)
    assert set(QUERIES) <= set(entry.queries()) and set(EXPECTED) <= set(entry.oracle_sql())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    assert compare(spark, SF, con, QUERIES[name], EXPECTED[name]) is None
