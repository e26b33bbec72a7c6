"""Every registered query against its SQL counterpart on the smallest tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry_points  # noqa: E402
from compare import compare, open_duckdb  # noqa: E402

TABLES = entry_points.SMALL_TABLES
QUERIES = entry_points.queries()

pytestmark = pytest.mark.skipif(not os.path.isdir(TABLES), reason="no tables")


@pytest.fixture(scope="module")
def db():
    return open_duckdb(TABLES)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, db, name):
    query = QUERIES[name]
    if query.sql is None:
        assert query(spark, TABLES).count() >= 0
        return
    problems = compare(spark, db, query, TABLES)
    assert not problems or problems == ["(empty)"]


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0


def test_every_sql_belongs_to_a_query():
    assert entry_points.oracle_sql().keys() <= QUERIES.keys()
