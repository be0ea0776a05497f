"""Every registered query with a SQL statement, against DuckDB on the smallest tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tools.check_queries import connect, difference, duckdb_rows, spark_rows

FOLDER = "/root/testdata/sf0.001"
STATEMENTS = oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(STATEMENTS))
def test_same_as_sql(spark, duck, name):
    found = spark_rows(queries()[name](spark, FOLDER))
    assert difference(found, duckdb_rows(duck, STATEMENTS[name])) is None


def test_statements_belong_to_queries():
    assert set(STATEMENTS) <= set(queries())


def test_entry_ranks_the_models(spark):
    assert {r["model"] for r in entry(spark).collect()} == {"majority", "keyword", "nb"}
