from __future__ import annotations

from functools import reduce

import pytest
from conftest import SMALL_SF
from plans import physical, same_rows

from lakestrata.operators import no_bet_rows, unpivot_pairs
from lakestrata.plans.ratings import BET_PAIRS, HAND_COLUMNS, TRIMMED, bets, no_bets
from lakestrata.sources.testviews import view
from pyspark.sql import functions as F

PAIRS = {"A": ("bet_a", "pay_a"), "B": ("bet_b", "pay_b")}


@pytest.fixture(scope="module")
def stored_wide(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("wide") / "rows")
    view(spark, SMALL_SF, "wide").write.parquet(path)
    return spark.read.parquet(path)


def test_edge_rows(spark):
    rows = spark.createDataFrame(
        [
            ("both", 10.0, 1.0, None, 2.0, 5.0),
            ("null bet", 10.0, None, 3.0, 0.0, 4.0),
            ("negative bet", 10.0, -1.0, 3.0, 1.5, -2.0),
            ("no total", None, 1.0, 1.0, 1.0, 1.0),
            ("zero total", 0.0, 1.0, 1.0, 1.0, 1.0),
        ],
        "id string, total double, bet_a double, pay_a double, bet_b double, pay_b double",
    )
    result = unpivot_pairs(rows, PAIRS, F.col("total") > 0, ("option", "bet", "payoff"))
    assert result.columns == ["id", "total", "option", "bet", "payoff"]
    assert {tuple(r) for r in result.drop("total").collect()} == {
        ("both", "A", 1.0, 0.0),
        ("both", "B", 2.0, 5.0),
        ("negative bet", "B", 1.5, -2.0),
    }


def test_mixed_measure_types_take_the_common_one(spark):
    rows = spark.sql("SELECT 1 AS id, 2 AS bet_a, CAST(3 AS DECIMAL(9,2)) AS pay_a, 4.5D AS bet_b, NULL AS pay_b")
    result = unpivot_pairs(rows, PAIRS, F.lit(True), measure_type="decimal(18,2)")
    assert result.schema["bet_amount"].dataType.simpleString() == "decimal(18,2)"
    assert result.schema["payoff_amount"].dataType.simpleString() == "decimal(18,2)"
    assert sorted(str(r.bet_amount) for r in result.collect()) == ["2.00", "4.50"]


def union_all(wide):
    """The bag union of one filtered scan per option."""

    def branch(label, bet, payoff):
        hands = wide.filter((F.col("bet_chip_sum") > 0) & (F.col(bet) > 0))
        trimmed = hands.withColumns({c: F.trim(c) for c in TRIMMED})
        key = F.concat_ws("-", "uid", "property", "game_info_uid", "box_number", F.lit(label))
        return trimmed.select(
            F.when(F.col("property").isNotNull(), key).alias("uid"),
            *[F.col(c).alias(name) for c, name in HAND_COLUMNS],
            F.lit(label).alias("bet_option"),
            F.col(bet).alias("bet_amount"),
            F.expr(f"coalesce({payoff}, 0BD)").cast("decimal(18,2)").alias("payoff_amount"),
        )

    return reduce(lambda a, b: a.unionAll(b), [branch(o, *pair) for o, pair in BET_PAIRS.items()])


def test_equals_union_all_of_one_branch_per_option(stored_wide):
    expected = union_all(stored_wide)
    result = bets(stored_wide)
    assert same_rows(result.select(*expected.columns), expected)
    assert result.select("bet_option").distinct().count() == 22


def test_plan_is_one_scan_with_pushed_guard_and_no_shuffle(stored_wide):
    plan = physical(bets(stored_wide))
    assert plan.count("FileScan") == 1
    assert plan.count("Expand") == 1
    assert "Exchange" not in plan and "Python" not in plan
    assert "GreaterThan(bet_chip_sum,0.00)" in plan
    assert "patron_id" not in plan.split("ReadSchema")[1]


def test_no_bet_rows_edges(spark):
    rows = spark.createDataFrame(
        [(0.0, "TOTAL", 1), (0.0, "R", 2), (None, "TOTAL", 3), (5.0, "TOTAL", 4), (0.0, None, 5)],
        "total double, chips string, id int",
    )
    assert [r.id for r in no_bet_rows(rows, "total", "chips").collect()] == [1]


def test_no_bets_plan_pushes_both_predicates(stored_wide):
    plan = physical(no_bets(stored_wide))
    assert "EqualTo(bet_chip_sum,0.00)" in plan and "EqualTo(chip_set_name,TOTAL)" in plan


def test_row_key_is_null_when_a_part_is(stored_wide):
    result = bets(stored_wide)
    assert result.filter("uid IS NULL").filter("property IS NOT NULL").isEmpty()
    assert not result.filter("uid IS NULL").isEmpty()
