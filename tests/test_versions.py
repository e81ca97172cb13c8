from __future__ import annotations

import random

import pytest
from conftest import SF
from plans import largest_method, physical

from lakestrata.operators import apply_changes, latest_by_key, read_current
from lakestrata.operators.versions import (
    lookup_bytes,
    merge_few_winners,
    merge_winners,
    winning_changes,
)
from lakestrata.plans.ewallet import TRANSACTION_DETAILS, keyed_target
from lakestrata.session import session_conf
from lakestrata.sources.testviews import view
from pyspark.sql import functions as F

SCHEMA = "id long, pt int, seq long, _row_kind string, value string"
KEYS = ("id", "pt")


def brute_force(rows):
    """The latest row of each key, before-images left out."""
    best = {}
    for row in rows:
        key = (row[0], row[1])
        if row[3] != "-U" and (key not in best or row[2] > best[key][2]):
            best[key] = row
    return set(best.values())


MERGES = (merge_winners, merge_few_winners)


def merged(spark, batches, merge):
    base = spark.createDataFrame([], SCHEMA)
    for batch in batches:
        changes = spark.createDataFrame(batch, SCHEMA)
        base = merge(base, winning_changes(changes, KEYS, "seq"), KEYS, "seq")
        base = spark.createDataFrame(base.collect(), SCHEMA)
    rows = [tuple(row) for row in base.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


CASES = {
    "insert then delete": [(1, 1, 1, "+I", "a"), (1, 1, 2, "-D", "a")],
    "delete then insert": [(1, 1, 1, "-D", "a"), (1, 1, 2, "+I", "b")],
    "before-image last": [(1, 1, 1, "+I", "a"), (1, 1, 3, "-U", "a"), (1, 1, 2, "+U", "b")],
    "late update after delete": [(1, 1, 5, "-D", "x"), (1, 1, 3, "+U", "old")],
    "same id in two partitions": [(1, 1, 1, "+I", "a"), (1, 2, 2, "+I", "b"), (1, 1, 3, "-D", "a")],
    "null key": [(None, 1, 1, "+I", "a"), (None, 1, 2, "+U", "b")],
    "no kind counts as a row": [(1, 1, 1, None, "a"), (1, 1, 2, None, "b")],
}


@pytest.mark.parametrize("merge", MERGES)
@pytest.mark.parametrize("name", list(CASES))
def test_edge_rows_one_by_one(spark, name, merge):
    rows = CASES[name]
    expected = brute_force(rows)
    assert merged(spark, [[row] for row in rows], merge) == expected
    assert merged(spark, [[row] for row in reversed(rows)], merge) == expected


def test_edge_rows_in_one_batch(spark):
    """All cases at once, told apart by their partition."""
    rows = [(r[0], r[1] + 10 * i, *r[2:]) for i, case in enumerate(CASES.values()) for r in case]
    changes = spark.createDataFrame(rows, SCHEMA)
    assert {tuple(r) for r in apply_changes(None, changes, KEYS, "seq").collect()} == brute_force(rows)


@pytest.mark.parametrize(("seed", "merge"), [(0, merge_winners), (1, merge_few_winners)])
def test_any_split_and_order_of_batches_and_repeats(spark, seed, merge):
    pick = random.Random(seed)
    kinds = ["+I", "+U", "-U", "-D"]
    rows = [
        (pick.randrange(6), pick.randrange(3), seq, pick.choice(kinds), f"v{seq}") for seq in range(120)
    ]
    shuffled = rows[:]
    pick.shuffle(shuffled)
    cuts = sorted(pick.sample(range(1, len(rows)), 2))
    batches = [shuffled[a:b] for a, b in zip([0, *cuts], [*cuts, len(rows)])]
    assert merged(spark, [*batches, batches[0]], merge) == brute_force(rows)


def test_read_current_hides_deletes_and_bookkeeping(spark):
    base = spark.createDataFrame(
        [(1, 1, 1, "+I", "a"), (2, 1, 2, "-D", "b"), (3, 1, 3, None, "c")], SCHEMA
    )
    current = read_current(base, hide=("seq",))
    assert current.columns == ["id", "pt", "value"]
    assert {r.id for r in current.collect()} == {1, 3}


@pytest.mark.parametrize("merge", MERGES)
def test_first_creation_can_be_kept(spark, merge):
    base = spark.createDataFrame([(1, 1, 1, "+I", "old"), (2, 1, 1, "-D", "old")], SCHEMA)
    changes = spark.createDataFrame([(i, 1, 2, "+U", "new") for i in (1, 2, 3)], SCHEMA)
    kept = merge(base, changes, KEYS, "seq", keep_first=("value",))
    assert {r.id: r.value for r in kept.collect()} == {1: "old", 2: "new", 3: "new"}
    moved = merge(base, changes, KEYS, "seq")
    assert {r.value for r in moved.collect()} == {"new"}
    stale = merge(changes, base, KEYS, "seq", keep_first=("value",))
    assert {r.value for r in stale.collect()} == {"new"}


def test_order_by_several_columns(spark):
    rows = spark.createDataFrame([(1, 1, 2), (1, 2, 1), (1, 2, None)], "id int, a int, b int")
    assert [tuple(r) for r in latest_by_key(rows, ["id"], ("a", "b")).collect()] == [(1, 2, 1)]


def test_group_limit_runs_before_the_shuffle(spark):
    plan = physical(latest_by_key(view(spark, SF, "feed"), ("id", "pt_created_date"), "seq"))
    assert plan.count("WindowGroupLimit") == 2
    before_shuffle = plan.split("Exchange")[1]
    assert "WindowGroupLimit" in before_shuffle
    assert "Python" not in plan


def test_hot_key_sends_one_row_per_task(spark):
    """A key holding half of all rows is cut down to a row per task before the shuffle."""
    feed = view(spark, SF, "feed").repartition(6)
    hot = feed.withColumn("id", F.when(F.col("seq") % 2 == 0, 0).otherwise(F.col("id"))).withColumn(
        "pt_created_date", F.when(F.col("seq") % 2 == 0, 20240101).otherwise(F.col("pt_created_date"))
    )
    keys = ("id", "pt_created_date")
    result = latest_by_key(hot, keys, "seq")
    expected = hot.groupBy(*keys).agg(F.max("seq").alias("seq"))
    assert result.select(*keys, "seq").exceptAll(expected).isEmpty()
    assert result.count() == expected.count()


def test_plans_of_both_merges(spark, tmp_path):
    keys = ("id", "pt_created_date")
    feed = view(spark, SF, "feed")
    paths = {name: str(tmp_path / name) for name in ("base", "winners")}
    winning_changes(feed, keys, "seq", "row_kind").write.parquet(paths["base"])
    winning_changes(feed.filter("seq > 9000"), keys, "seq", "row_kind").write.parquet(paths["winners"])
    base, winners = (spark.read.parquet(path) for path in paths.values())

    few = physical(merge_few_winners(base, winners, keys, "seq", "row_kind"))
    assert "SortMergeJoin" not in few and "hashpartitioning" not in few
    assert few.count("BroadcastHashJoin") == 3

    many = physical(merge_winners(base, winners, keys, "seq", "row_kind"))
    assert many.count("FileScan") == 2 and many.count("Exchange hashpartitioning") == 2
    assert "Broadcast" not in many


def test_lookup_size_counts_keys_and_sequences(spark):
    rows = spark.sql("SELECT * FROM VALUES ('abcd', 1), (NULL, 10) AS t(k, s)")
    assert lookup_bytes(rows, ["k"], "s") == (64 + 4 + 1) + (64 + 2)
    assert lookup_bytes(rows.limit(0), ["k"], "s") == 0


def test_a_merge_of_wide_rows_has_no_method_too_large_to_compile(spark, tmp_path):
    target = keyed_target(TRANSACTION_DETAILS, str(tmp_path / "table"), seq=("payment_id",))
    spark.createDataFrame([], target.schema).write.parquet(f"{tmp_path}/rows")
    rows = [spark.read.parquet(f"{tmp_path}/rows") for _ in range(2)]
    with session_conf(spark, {"spark.sql.adaptive.enabled": "false"}):
        assert largest_method(merge_winners(*rows, target.keys, target.seq, target.kind)) < 8000


def test_a_full_merge_keeps_first_values_of_live_rows_only(spark):
    base = spark.createDataFrame([(1, 1, 5, "+I", "a"), (2, 1, 5, "-D", "b"), (3, 1, 9, "+I", "c"), (5, 1, 1, "+I", None)], SCHEMA)
    new = spark.createDataFrame([(1, 1, 6, "+U", "x"), (2, 1, 6, "+U", "y"), (3, 1, 6, "+U", "z"), (4, 1, 1, "+I", "n"), (5, 1, 2, "+U", "o")], SCHEMA)
    kept = {tuple(r) for r in merge_winners(base, new, KEYS, "seq", keep_first=("value",)).collect()}
    assert kept == {(1, 1, 6, "+U", "a"), (2, 1, 6, "+U", "y"), (3, 1, 9, "+I", "c"), (4, 1, 1, "+I", "n"), (5, 1, 2, "+U", "o")}
