"""Queries that SQL can express, against DuckDB over whole tables."""

from __future__ import annotations

import pytest
from compare import assert_same_rows, duck
from conftest import SF, SMALL_SF

from lakestrata.llm.oracles import ORACLE_SQL
from lakestrata.llm.queries import QUERIES


@pytest.mark.parametrize("sf_dir", [SF, SMALL_SF])
@pytest.mark.parametrize("name", list(ORACLE_SQL))
def test_query_equals_sql(spark, name, sf_dir):
    assert assert_same_rows(duck(sf_dir), QUERIES[name](spark, sf_dir), ORACLE_SQL[name]) > 0
