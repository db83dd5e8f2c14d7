"""Every named query against its SQL, and the contract of the entry file."""

import pytest

import __spark_entry__ as entry_file
from logweir.plans import oracle, queries
from tests import compare

QUERIES, SQL = queries.catalog(), oracle.catalog()


@pytest.fixture(scope="module")
def con(sf):
    return compare.connect(sf)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry_file.queries())
    assert set(SQL) <= set(entry_file.oracle_sql())


def test_entry_gives_alerts(spark):
    rows = entry_file.entry(spark)
    assert rows.count() == 35
    assert "alert_message" in rows.columns


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, con, sf, name):
    names, rows = compare.spark_rows(QUERIES[name](spark, sf))
    sql_names, sql_rows = compare.sql_rows(con, SQL[name])
    assert names == sql_names
    assert rows == sql_rows
