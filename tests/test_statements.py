"""Every registered query with a SQL statement gives the same rows."""

import pytest
from compare import connect, differences
from conftest import SMALL

import __spark_entry__ as entry

STATEMENTS = entry.oracle_sql()


@pytest.fixture(scope="module")
def sql():
    return connect(SMALL)


def test_every_statement_has_a_query():
    assert set(STATEMENTS) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(STATEMENTS))
def test_same_rows(spark, sql, name):
    assert differences(sql, entry.queries()[name](spark, SMALL), STATEMENTS[name]) == []


def test_flagship(spark):
    result = entry.entry(spark)
    assert {"user_id", "rfm_score", "segment"} <= set(result.columns)
    assert result.count() == 150
