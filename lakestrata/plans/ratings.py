"""Hand-by-hand ratings: one row per bet, and the hands without a bet."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestrata.functions import joined_key
from lakestrata.operators.reshape import no_bet_rows as without_bet
from lakestrata.operators.reshape import select_as, unpivot_pairs

# Bet option label, and its name inside the measure columns.
BET_OPTIONS = (
    ("PlayerWin", "player_win"),
    ("BankerWin", "banker_win"),
    ("Tie", "tie"),
    ("PlayerPair", "player_pair"),
    ("BankerPair", "banker_pair"),
    ("Lucky6", "lucky6"),
    ("Lucky6Small", "lucky6_small"),
    ("Lucky6Big", "lucky6_big"),
    ("Fortune6", "fortune6"),
    ("Tiger", "tiger"),
    ("SmallTiger", "small_tiger"),
    ("BigTiger", "big_tiger"),
    ("TigerTie", "tiger_tie"),
    ("TigerPair", "tiger_pair"),
    ("BankerIns1", "banker_ins1"),
    ("PlayerIns1", "player_ins1"),
    ("BankerIns2", "banker_ins2"),
    ("PlayerIns2", "player_ins2"),
    ("Super7", "super7"),
    ("SuperLucky", "super_lucky"),
    ("Lucky72", "lucky72"),
    ("Lucky73", "lucky73"),
)

BET_PAIRS = {
    label: (f"bet_chip_{name}_average", f"pay_off_{name}_average") for label, name in BET_OPTIONS
}

# Output columns of the no-bet table, as (source column, column).
# The bet table has the same ones, its own key in front, and the bet itself.
HAND_COLUMNS = (
    ("uid", "hand_by_hand_uid"),
    ("rating_id", "rating_id"),
    ("game_info_uid", "game_info_uid"),
    ("property", "property"),
    ("dt", "dt"),
    ("game_id", "game_id"),
    ("seated_patron_exists", "seated_patron_exists"),
    ("game_start_datetime", "game_start_datetime"),
    ("game_finish_datetime", "game_finish_datetime"),
    ("hardware_id", "table_device_id"),
    ("operation_id", "operation_id"),
    ("bet_chip_sum", "bet_chip_sum"),
    ("pay_off_sum", "pay_off_sum"),
    ("box_number", "box_number"),
    ("chip_set_name", "chipset_type"),
    ("create_datetime", "create_datetime"),
)
TRIMMED = ("game_id", "hardware_id")


def _hands(wide: DataFrame) -> DataFrame:
    return wide.withColumns({column: F.trim(column) for column in TRIMMED})


def bets(wide: DataFrame, measure_type: str | None = None) -> DataFrame:
    """One row per hand and bet option with a stake; a missing payoff is 0.

    ``uid`` is NULL when a part of it is, so it is no key by itself. What does
    not depend on the option is computed before the unpivot, once per hand.
    """
    hands = _hands(wide).select(
        joined_key(F.col("uid"), F.col("property"), F.col("game_info_uid"), F.col("box_number")).alias(
            "_hand_key"
        ),
        *[F.col(column).alias(name) for column, name in HAND_COLUMNS],
        *[column for pair in BET_PAIRS.values() for column in pair],
    )
    long = unpivot_pairs(hands, BET_PAIRS, F.col("bet_chip_sum") > 0, measure_type=measure_type)
    names = [name for _, name in HAND_COLUMNS]
    until_box = names[: names.index("box_number") + 1]
    return long.select(
        joined_key(F.col("_hand_key"), F.col("bet_option")).alias("uid"),
        *until_box,
        "bet_option",
        "chipset_type",
        "bet_amount",
        "payoff_amount",
        "create_datetime",
    )


def no_bets(wide: DataFrame) -> DataFrame:
    """Hands of the whole chip set on which nothing was staked."""
    return select_as(_hands(without_bet(wide, "bet_chip_sum", "chip_set_name")), HAND_COLUMNS)
