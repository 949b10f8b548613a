"""Every query against its SQL counterpart on whole tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from loomtally.plans.catalog import QUERIES
from compare import difference, open_tables

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables():
    connection = open_tables(FOLDER)
    yield connection
    connection.close()


def test_every_query_has_sql():
    assert QUERIES.keys() <= queries().keys()
    assert QUERIES.keys() <= oracle_sql().keys() <= queries().keys()


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_agrees_with_sql(spark, tables, name):
    assert difference(queries()[name](spark, FOLDER), tables, oracle_sql()[name]) is None
