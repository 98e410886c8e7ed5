"""Every registered query against its SQL counterpart on the smallest data."""

import pytest
from compare import connect, difference

import __spark_entry__ as entry
from corpusloom.queries import all_queries

QUERIES, ORACLES = all_queries()


@pytest.fixture(scope="module")
def duck(sf):
    return connect(sf)


@pytest.mark.parametrize("name", QUERIES)
def test_matches_sql(name, spark, sf, duck):
    ours = QUERIES[name](spark, sf).toArrow()
    assert difference(ours, duck.sql(ORACLES[name]).to_arrow_table()) is None


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
