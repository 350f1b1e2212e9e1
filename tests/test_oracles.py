"""Every registered query against its SQL at the smallest scale."""

import pytest
from compare import differences, duck
from conftest import SMALL

import __spark_entry__ as contract
from tracklens.workload import all_queries

QUERIES, ORACLES = all_queries.QUERIES, all_queries.ORACLES


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(contract.queries())
    assert set(ORACLES) == set(QUERIES)


def test_entry_returns_rows(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    assert differences(QUERIES[name](spark, SMALL), con, ORACLES[name]) is None
