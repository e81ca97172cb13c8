"""Latest row per key, and merging a batch of changes into a keyed table.

The newest row is the one with the greatest sequence, which the caller must
supply with a total order per key: a DataFrame has no arrival order to go by.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROW_KIND = "_row_kind"
# The kinds a change row can have.
INSERT, UPDATE_BEFORE, UPDATE_AFTER, DELETE = "+I", "-U", "+U", "-D"


def _columns(names: str | Sequence[str]) -> list[str]:
    return [names] if isinstance(names, str) else list(names)


def latest_by_key(df: DataFrame, keys: Sequence[str], order_cols: str | Sequence[str]) -> DataFrame:
    """One row per key, the one with the greatest ``order_cols``.

    Spark plans ``row_number() = 1`` with a group limit before the shuffle, so
    every task sends at most one row per key: a key that holds a third of the
    table costs one row per task.
    """
    newest_first = [F.col(c).desc() for c in _columns(order_cols)]
    window = Window.partitionBy(*keys).orderBy(*newest_first)
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def winning_changes(
    changes: DataFrame, keys: Sequence[str], seq: str | Sequence[str], kind: str = ROW_KIND
) -> DataFrame:
    """The change per key that counts: before-images do not, deletes do."""
    return latest_by_key(changes.filter(~F.col(kind).eqNullSafe(UPDATE_BEFORE)), keys, seq)


def apply_changes(
    base: DataFrame | None,
    changes: DataFrame,
    keys: Sequence[str],
    seq: str | Sequence[str],
    kind: str = ROW_KIND,
    keep_first: Sequence[str] = (),
) -> DataFrame:
    """Base rows with a batch of changes merged in; deleted keys stay as ``-D`` rows.

    ``base`` holds one row per key, its sequence and kind included: without the
    kept deletes a late, older update would bring a row back. A change with the
    sequence the base already has is not applied again, so replays do nothing.
    ``keep_first`` columns keep the value of the live row that is replaced.
    """
    winners = winning_changes(changes, keys, seq, kind)
    if base is None:
        return winners
    return merge_winners(base, winners, keys, seq, kind, keep_first)


def merge_winners(
    base: DataFrame,
    winners: DataFrame,
    keys: Sequence[str],
    seq: str | Sequence[str],
    kind: str = ROW_KIND,
    keep_first: Sequence[str] = (),
) -> DataFrame:
    """``apply_changes`` for changes of any size that already hold one row per key.

    Each side is shuffled once, on keys unique in it, so no task runs hot. A row
    is chosen as a whole: a choice per column makes a method of generated code
    that is too large for the JVM to compile.
    """
    new_keys, old_keys = [f"_new_{i}" for i in range(len(keys))], [f"_old_{i}" for i in range(len(keys))]
    stored = base.select(*_renamed(keys, old_keys), F.struct(*_quoted(base.columns)).alias("_old"))
    arrived = winners.select(*_renamed(keys, new_keys), F.struct(*_quoted(base.columns)).alias("_new"))
    both = stored.join(arrived, _same(old_keys, new_keys), "full")
    newer = _version(_side("_new", _columns(seq))) > _version(_side("_old", _columns(seq)))
    take_new = F.col("_new").isNotNull() & (F.col("_old").isNull() | newer)

    new = F.col("_new")
    if keep_first:
        live = F.col("_old").isNotNull() & ~F.col(f"_old.`{kind}`").eqNullSafe(DELETE)
        fields = {column: F.col(f"_new.`{column}`") for column in base.columns}
        for column in keep_first:
            fields[column] = F.coalesce(F.when(live, F.col(f"_old.`{column}`")), fields[column])
        new = F.struct(*[value.alias(column) for column, value in fields.items()])
    return both.select(F.when(take_new, new).otherwise(F.col("_old")).alias("_row")).select("_row.*")


def merge_few_winners(
    base: DataFrame,
    winners: DataFrame,
    keys: Sequence[str],
    seq: str | Sequence[str],
    kind: str = ROW_KIND,
    keep_first: Sequence[str] = (),
) -> DataFrame:
    """``merge_winners`` for changes whose keys and sequences were checked to fit a broadcast.

    The base is never shuffled: a broadcast lookup drops its replaced rows, and
    a second, narrow pass finds what those were.
    """
    new_keys = [f"_new_{i}" for i in range(len(keys))]
    old_keys = [f"_old_{i}" for i in range(len(keys))]
    version = _version(_columns(seq))

    incoming = F.broadcast(winners.select(*_renamed(keys, new_keys), version.alias("_new_version")))
    stays = F.col("_new_version").isNull() | (version >= F.col("_new_version"))
    kept = base.join(incoming, _same(keys, new_keys), "left").filter(stays).select(*base.columns)

    replaced = base.join(incoming, _same(keys, new_keys), "left_semi").select(
        *_renamed(keys, old_keys),
        version.alias("_old_version"),
        (~F.col(kind).eqNullSafe(DELETE)).alias("_old_live"),
        *[F.col(c).alias(f"_first_{c}") for c in keep_first],
    )
    wins = F.col("_old_version").isNull() | (version > F.col("_old_version"))
    fresh = winners.join(replaced, _same(keys, old_keys), "left").filter(wins)
    for column in keep_first:
        carried = F.when(F.col("_old_live"), F.col(f"_first_{column}"))
        fresh = fresh.withColumn(column, F.coalesce(carried, F.col(column)))
    return kept.unionByName(fresh.select(*base.columns))


def lookup_width(keys: Sequence[str], seq: str | Sequence[str]) -> Column:
    """Bytes of a row of what ``merge_few_winners`` broadcasts: keys and sequences, as text, plus overhead."""
    width = F.lit(64)
    for column in [*keys, *_columns(seq)]:
        width = width + F.coalesce(F.octet_length(F.col(column).cast("string")), F.lit(0))
    return width


def lookup_bytes(winners: DataFrame, keys: Sequence[str], seq: str | Sequence[str]) -> int:
    """Bytes of all that ``merge_few_winners`` broadcasts."""
    return winners.agg(F.sum(lookup_width(keys, seq))).first()[0] or 0


def read_current(
    base: DataFrame, kind: str = ROW_KIND, hide: Sequence[str] = ()
) -> DataFrame:
    """What a reader of the table sees: no deleted rows, no bookkeeping columns."""
    return base.filter(~F.col(kind).eqNullSafe(DELETE)).drop(kind, *hide)


def _quoted(names: Sequence[str]) -> list[str]:
    return [f"`{name}`" for name in names]


def _side(side: str, names: Sequence[str]) -> list[str]:
    return [f"{side}.`{name}`" for name in names]


def _version(seq: Sequence[str]) -> Column:
    return F.struct(*[F.col(c).alias(f"v{i}") for i, c in enumerate(seq)])


def _renamed(names: Sequence[str], to: Sequence[str]) -> list[Column]:
    return [F.col(name).alias(new) for name, new in zip(names, to)]


def _same(left: Sequence[str], right: Sequence[str]) -> Column:
    condition = F.lit(True)
    for a, b in zip(left, right):
        condition = condition & F.col(a).eqNullSafe(F.col(b))
    return condition
