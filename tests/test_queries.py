"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import pytest
from oracle import connect, differences

from __spark_entry__ import SMOKE_DIR, entry, oracle_sql, queries

QUERIES, ORACLES = queries(), oracle_sql()


@pytest.fixture(scope="module")
def connection():
    return connect(SMOKE_DIR)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_sql(spark, connection, name):
    assert differences(QUERIES[name](spark, SMOKE_DIR), connection, ORACLES[name]) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_sql_returns_rows(spark, name):
    assert QUERIES[name](spark, SMOKE_DIR).limit(1).count() == 1


def test_flagship_query(spark):
    assert entry(spark).count() == 5


def test_comparison_notices_a_wrong_value(spark, connection):
    found = differences(
        QUERIES["report_cards"](spark, SMOKE_DIR), connection, ORACLES["report_cards"].replace("credit_risk = 1", "credit_risk = 0")
    )
    assert found
