"""Every registered query against its SQL on the smallest sample."""

import pytest

import __spark_entry__ as contract
from check import spark_rows, sql_rows

QUERIES = contract.BATCH_QUERIES | contract.STREAM_QUERIES
SQL = contract.BATCH_SQL | contract.STREAM_SQL


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, samples, name):
    assert spark_rows(QUERIES[name](spark, samples)) == sql_rows(samples, SQL[name])


def test_every_sql_has_a_query():
    assert set(SQL) == set(QUERIES)


def test_entry_is_the_flagship(spark):
    rows = contract.entry(spark).collect()
    assert len(rows) == 10 and rows[0]["count"] >= rows[-1]["count"]
