"""The raw tables as views: Spark's form against the one that the checks use."""

from __future__ import annotations

import datetime as dt

import pytest
from conftest import SF
from plans import largest_method, physical, same_rows

from lakestrata.plans.ratings import bets
from lakestrata.queries import dwd_payments, dwd_transaction_details, no_bet_rows, unpivot_bets
from lakestrata.sources.testviews import VIEWS, table_schema, view_of

JVM_LIMIT = 8000
DAY = dt.datetime(2024, 1, 5, 3, 4, 5, 678901)
ROWS = {
    "orders": [
        *[(n, 7 * n, "O", 10.5 * n, DAY, "1-URGENT") for n in range(1, 25)],
        (None, None, None, None, None, None),
        (-13, 1, "F", -2.25, DAY, None),
    ],
    "lineitem": [
        *[(n, n, n + 1, n % 7, n + 0.5, 99.125 * n, 0.1, 0.2, "A", "O", DAY) for n in range(1, 40)],
        (None, None, None, None, None, None, None, None, None, None, None),
        (5, None, None, 2, 3.0, 4.0, 0.0, 0.0, "R", "F", DAY),
        (6, -5, -4, 1, -1.0, None, 0.0, 0.0, "N", None, None),
    ],
    "events": [
        *[(n, DAY, n % 3, kind, n / 7, None) for n, kind in enumerate(["error", "click", "signup", "view"] * 6)],
        (None, None, None, None, None, None),
    ],
}


@pytest.mark.parametrize("name", ["pay", "txn", "pay_feed", "txn_feed", "wide"])
def test_both_forms_give_the_same_rows(spark, name):
    table, columns, origin = VIEWS[name]
    rows = spark.createDataFrame(ROWS[table], table_schema(table))
    plain = spark.sql(f"SELECT {columns} FROM {origin}", rows=rows)
    shared = view_of(rows, name)
    assert [(f.name, f.dataType) for f in shared.schema] == [(f.name, f.dataType) for f in plain.schema]
    assert same_rows(shared, plain)
    assert shared.count() == len(ROWS[table])


@pytest.mark.parametrize("query", [dwd_payments, dwd_transaction_details])
def test_detail_jobs_have_no_method_too_large_to_compile(spark, query):
    assert largest_method(query(spark, SF)) < JVM_LIMIT


def test_bets_have_no_method_too_large_to_compile(spark):
    result = unpivot_bets(spark, SF)
    assert largest_method(result) < JVM_LIMIT
    plan = physical(result)
    assert plan.count("FileScan") == plan.count("Expand") == 1
    assert "Exchange" not in plan and "l_linenumber" in plan.split("DataFilters")[1].split("]")[0]


def test_hands_whose_measures_are_not_asked_for_make_none(spark):
    assert "transform" not in physical(no_bet_rows(spark, SF))


def test_bets_of_every_turn_of_part_and_supplier(spark, tmp_path):
    turns = [None, *range(-5, 9)]
    rows = [
        (part, part, supp, 1, quantity, 10.0, 0.0, 0.0, "A", "O", DAY)
        for part in turns
        for supp in turns
        for quantity in (2.0, 0.0, -3.5, None)
    ]
    spark.createDataFrame(rows, table_schema("lineitem")).write.parquet(f"{tmp_path}/lineitem.parquet")
    table, columns, origin = VIEWS["wide"]
    plain = spark.sql(f"SELECT {columns} FROM {origin}", rows=spark.read.parquet(f"{tmp_path}/lineitem.parquet"))
    result, expected = unpivot_bets(spark, str(tmp_path)), bets(plain)
    assert result.schema == expected.schema
    assert same_rows(result, expected)
    assert result.count() > 15 * 15 * 10
