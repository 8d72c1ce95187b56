"""Every registered query against its SQL in DuckDB."""

import pytest
from check_oracle import compare, connect

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_sql():
    assert set(entry.stream_queries()) == set(entry.stream_sql())


@pytest.mark.parametrize("name", entry.stream_queries())
def test_query(spark, con, name):
    same, n, m, *_ = compare(spark, con, SF, name)
    assert same and n == m > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
