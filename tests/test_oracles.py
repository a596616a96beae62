"""Every registered query equals its SQL at the smallest scale factor."""

import pytest

import __spark_entry__ as entry
from lakeops import registry
from check_queries import compare

QUERIES, ORACLES = registry.QUERIES, registry.ORACLES


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, sf, name):
    got = QUERIES[name](spark, sf).toArrow()
    want = duck.sql(ORACLES[name]).to_arrow_table()
    assert compare(got, want) == ""


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0
