"""Every registered query against its SQL on the given tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry_point
from playtrail.plans.table_oracles import table_oracles
from playtrail.plans.table_queries import table_queries
from tests.conftest import SF_DIR, TABLES, rows_of

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="the given tables are not here")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    yield connection
    connection.close()


def test_every_query_has_sql():
    """The text operators have tests of their own where SQL can't express them."""
    assert set(table_oracles()) == set(table_queries())
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())


@pytest.mark.parametrize("name", sorted(entry_point.oracle_sql()))
def test_query_agrees_with_sql(spark, duck, sf_dir, name):
    found = entry_point.queries()[name](spark, sf_dir)
    result = duck.execute(entry_point.oracle_sql()[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(found.columns)
    expected = [tuple(row) for row in result.fetchall()]
    expected.sort(key=lambda row: [(v is None, str(v)) for v in row])
    assert rows_of(found.select(*columns)) == expected


def test_flagship(spark):
    assert entry_point.entry(spark).count() > 0
