"""Every registered query against its SQL twin."""

from __future__ import annotations

import pytest
from oracle_compare import connect, differences

import __spark_entry__ as E
from eventmarts.plans.oracle import all_oracles
from eventmarts.plans.queries import all_queries

QUERIES = all_queries()
ORACLES = all_oracles()


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, sf, con, name):
    assert differences(QUERIES[name](spark, sf), con, ORACLES[name]) == []


def test_all_are_registered():
    assert set(QUERIES) <= set(E.queries()) and set(ORACLES) <= set(E.oracle_sql())


def test_entry_has_rows(spark, sf):
    assert E.entry(spark).count() > 0
