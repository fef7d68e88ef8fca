"""Every registered query against its SQL in DuckDB, on the smallest tables."""

import pytest
from oracle_check import connect, differences

from __spark_entry__ import entry, oracle_sql, queries
from logilake.catalog import all_queries

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


def test_every_query_of_the_catalog_has_sql():
    assert set(all_queries()) <= set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_agrees_with_sql(spark, con, name):
    assert differences(spark, con, SMALL, name) is None


def test_entry_gives_rows(spark):
    assert not entry(spark).isEmpty()
