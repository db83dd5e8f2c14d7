"""Every corpus query is registered; those with SQL equal it."""

import pytest

import __spark_entry__ as entry_file
from logweir.llm import queries
from tests import compare

OPERATORS = [f"op{n}_" for n in range(1, 14)]


def test_one_query_for_each_operator():
    names = list(queries.catalog())
    assert [n.split("_")[0] + "_" for n in names] == OPERATORS
    assert {*names, "pipeline"} <= set(entry_file.queries())
    assert set(queries.oracle_catalog()) <= set(entry_file.oracle_sql())


@pytest.mark.parametrize("name", sorted(queries.oracle_catalog()))
@pytest.mark.parametrize("scale", ["0.001", "0.01"])
def test_query_equals_sql(spark, name, scale):
    sf_dir = f"/root/testdata/sf{scale}"
    names, rows = compare.spark_rows(queries.catalog()[name](spark, sf_dir))
    sql_names, sql_rows = compare.sql_rows(compare.connect(sf_dir), queries.oracle_catalog()[name])
    assert names == sql_names
    assert rows == sql_rows
