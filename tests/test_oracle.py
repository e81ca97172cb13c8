"""Every registered query against its SQL, over whole tables."""

from __future__ import annotations

import pytest
from compare import assert_same_rows, duck
from conftest import SF

import __spark_entry__ as entry_point
from lakestrata.oracles import ORACLE_SQL as SQL
from lakestrata.queries import QUERIES

# Rows at this scale that both engines were seen to agree on before this code was written.
CONTROL_ROWS = {
    "dwd_payments": 13500,
    "dwd_transaction_details": 53989,
    "unpivot_bets": 565118,
    "no_bet_rows": 2903,
    "latest_by_key": 4006,
    "apply_changes": 2826,
    "stream_upsert": 2826,
    "append_changes": 10000,
    "late_file_load": 10000,
    "upsert_twice_same_name": 2826,
    "expire_partitions": 11935,
    "model_success_transactions": 1981,
    "page_views_per_minute": 1938,
}


@pytest.fixture(scope="module")
def connection():
    return duck(SF)


def test_every_query_has_a_check_and_is_registered():
    assert set(QUERIES) == set(SQL)
    assert QUERIES.items() <= entry_point.queries().items()
    assert SQL.items() <= entry_point.oracle_sql().items()
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, connection, name):
    rows = assert_same_rows(connection, QUERIES[name](spark, SF), SQL[name])
    assert rows == CONTROL_ROWS.get(name, rows) > 0


def test_entry(spark):
    result = entry_point.entry(spark)
    assert result.count() > 0
    assert len(result.columns) == 20
