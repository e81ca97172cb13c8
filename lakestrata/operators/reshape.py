"""Wide measure pairs to long rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestrata.functions import zero_if_null


def unpivot_pairs(
    df: DataFrame,
    pairs: Mapping[str, tuple[str, str]],
    guard: Column,
    names: tuple[str, str, str] = ("bet_option", "bet_amount", "payoff_amount"),
    measure_type: str | None = None,
) -> DataFrame:
    """One row per label whose first measure is positive, for the rows that pass ``guard``.

    ``pairs`` is label to (first, second) column; all other columns of ``df``
    are carried, so select the needed ones first. A NULL second measure gives 0.
    Plans as one Expand over one scan without a shuffle, in batch and stream.
    ``measure_type`` is the common type of the measures where they differ.
    """
    label, first, second = names
    if measure_type:
        measures = [column for pair in pairs.values() for column in pair]
        df = df.withColumns({column: F.col(column).cast(measure_type) for column in measures})
    listed = ", ".join(f"(`{a}`, `{b}`) AS `{option}`" for option, (a, b) in pairs.items())
    long = df.sparkSession.sql(
        f"SELECT * FROM {{wide}} UNPIVOT INCLUDE NULLS"
        f" ((`{first}`, `{second}`) FOR `{label}` IN ({listed}))",
        wide=df.filter(guard),
    )
    payoff = zero_if_null(F.col(second), long.schema[second].dataType)
    return long.filter(F.col(first) > 0).withColumn(second, payoff)


def no_bet_rows(df: DataFrame, total: str, set_name: str, whole_set: str = "TOTAL") -> DataFrame:
    """Rows of the whole chip set on which nothing was staked."""
    return df.filter((F.col(total) == 0) & (F.col(set_name) == whole_set))


def select_as(df: DataFrame, columns: Sequence[tuple[str, str]]) -> DataFrame:
    """Project (column, new name) pairs in order."""
    return df.select(*[F.col(column).alias(name) for column, name in columns])
