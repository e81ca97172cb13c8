from __future__ import annotations

import glob
import time
from dataclasses import replace

import pytest
from conftest import SF
from plans import same_rows

from lakestrata.operators import latest_by_key, read_current, upsert
from lakestrata.operators.versions import ROW_KIND
from lakestrata.plans.ewallet import PAYMENTS, TRANSACTION_DETAILS, keyed_target, to_detail
from lakestrata.plans.ratings import bets
from lakestrata.plans.views import page_views_per_minute
from lakestrata.queries import AS_OF, FEED_KEYS, FEED_SCHEMA, feed_target
from lakestrata.sources.readers import scan, set_modified
from lakestrata.sources.testviews import table_rows, view
from lakestrata.streaming import Load, run_loads, start_load
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F


@pytest.fixture(scope="module")
def feed_files(spark, tmp_path_factory):
    """The feed in six files whose sequences are mixed."""
    path = str(tmp_path_factory.mktemp("feed") / "rows")
    feed = view(spark, SF, "feed").select(*FEED_SCHEMA.names)
    feed.withColumn("part", F.expr("pmod(hash(seq), 6)")).repartition(6, "part").drop("part").write.parquet(path)
    return path


def append(name, folder, source, transform=lambda rows: rows, partition=None):
    return Load(name, source, transform, f"{folder}/checkpoint", append_to=f"{folder}/rows", partition=partition)


def small_batches(path):
    return lambda session: scan(session, path, FEED_SCHEMA, streaming=True, max_bytes_per_batch=60_000)


def test_several_batches_out_of_order_equal_the_batch_query(spark, tmp_path, feed_files):
    target = feed_target(str(tmp_path / "table"))
    load = Load("upsert-batches", small_batches(feed_files), lambda rows: rows, str(tmp_path / "ckpt"), upsert_into=target)
    query = start_load(spark, load, bounded=True)
    query.awaitTermination()
    assert sum(p["numInputRows"] > 0 for p in query.recentProgress) >= 3
    feed = spark.read.parquet(feed_files)
    expected = read_current(latest_by_key(feed.filter("row_kind <> '-U'"), FEED_KEYS, "seq"), "row_kind")
    assert same_rows(read_current(target.read(spark), "row_kind").select(*expected.columns), expected)
    assert target.read(spark).count() == 3771

    before = target.read(spark)
    rows = {tuple(r) for r in before.collect()}
    run_loads(spark, [load], bounded=True)
    assert {tuple(r) for r in target.read(spark).collect()} == rows


def test_restart_takes_only_new_files(spark, tmp_path):
    source, schema = str(tmp_path / "in"), "id long"
    spark.range(5).write.parquet(source)
    load = append("resume", tmp_path, lambda s: scan(s, source, _schema(spark, schema), streaming=True))
    run_loads(spark, [load], bounded=True)
    run_loads(spark, [load], bounded=True)
    assert spark.read.parquet(load.append_to).count() == 5
    spark.range(5, 8).write.mode("append").parquet(source)
    run_loads(spark, [load], bounded=True)
    assert sorted(r.id for r in spark.read.parquet(load.append_to).collect()) == list(range(8))


def _schema(spark, ddl):
    return spark.createDataFrame([], ddl).schema


def test_unpivot_stream_equals_batch(spark, tmp_path):
    load = append("bets", tmp_path, lambda s: view(s, "/root/testdata/sf0.001", "wide", streaming=True), bets)
    run_loads(spark, [load], bounded=True)
    assert same_rows(spark.read.parquet(load.append_to), bets(view(spark, "/root/testdata/sf0.001", "wide")))


def test_unpivot_stream_is_written_by_several_tasks(spark, tmp_path):
    load = append("spread", tmp_path, lambda s: view(s, SF, "wide", streaming=True), bets)
    run_loads(spark, [load], bounded=True)
    assert len(glob.glob(f"{load.append_to}/*.parquet")) > 1


def test_an_even_source_is_shuffled_once_as_it_was_stored(spark, tmp_path):
    source = lambda s: view(s, SF, "wide", streaming=True, even=True)
    load = replace(append("even", tmp_path, source, bets), even=True)
    query = start_load(spark, load, bounded=True)
    query.awaitTermination()
    plan = query._jsq.explainInternal(False)
    final = plan.split("== Initial Plan ==")[0]
    assert final.count("REBALANCE_PARTITIONS_BY_NONE") == 1
    assert "l_quantity" in final and "bet_chip" not in final.split("REBALANCE_PARTITIONS_BY_NONE")[1]
    files = glob.glob(f"{load.append_to}/*.parquet")
    assert files and all(".zstd." in file for file in files)
    assert same_rows(spark.read.parquet(load.append_to), bets(view(spark, SF, "wide")))


@pytest.mark.parametrize("age", [1, 30, 3000])
def test_files_with_old_time_stamps_are_taken(spark, tmp_path, age):
    source = str(tmp_path / "in")
    load = append("late", tmp_path, lambda s: scan(s, f"{source}/*", _schema(spark, "id long"), streaming=True))
    spark.range(5).write.parquet(f"{source}/first")
    run_loads(spark, [load], bounded=True)
    spark.range(5, 10).write.parquet(f"{source}/second")
    set_modified(spark, f"{source}/second", "*.parquet", age)
    run_loads(spark, [load], bounded=True)
    assert sorted(r.id for r in spark.read.parquet(load.append_to).collect()) == list(range(10))


def test_a_batch_replayed_after_a_backfill_undoes_nothing(spark, tmp_path):
    """The stream merged a batch but was lost before its commit; a backfill runs before it starts again."""
    feed = view(spark, SF, "feed").select(*FEED_SCHEMA.names)
    target = feed_target(str(tmp_path / "table"))
    first, second = feed.filter("seq % 2 = 0"), feed.filter("seq % 2 = 1")
    for rows in (first, second, first):
        upsert(spark, target, rows)
    expected = read_current(latest_by_key(feed.filter("row_kind <> '-U'"), FEED_KEYS, "seq"), "row_kind")
    assert same_rows(read_current(target.read(spark), "row_kind").select(*expected.columns), expected)


def test_one_failing_load_stops_the_others(spark, tmp_path):
    good = append("good", tmp_path / "good", lambda s: s.readStream.format("rate").load())
    bad = append(
        "bad",
        tmp_path / "bad",
        lambda s: s.readStream.format("rate").load(),
        lambda rows: rows.select(F.raise_error(F.lit("broken")).cast("string").alias("x")),
    )
    often = [replace(load, interval="1 second") for load in (good, bad)]
    with pytest.raises(StreamingQueryException, match="broken"):
        run_loads(spark, often)
    assert not [q for q in spark.streams.active if q.name in ("good", "bad")]


def test_loads_that_cannot_start_leave_nothing_running(spark, tmp_path):
    good = append("early", tmp_path / "good", lambda s: s.readStream.format("rate").load())
    neither = Load("neither", good.source, good.transform, str(tmp_path / "x"))
    with pytest.raises(ValueError, match="exactly one sink"):
        run_loads(spark, [good, neither])
    assert not [q for q in spark.streams.active if q.name == "early"]


def test_unbounded_load_keeps_running_under_its_name(spark, tmp_path):
    load = append("rate-load", tmp_path, lambda s: s.readStream.format("rate").option("rowsPerSecond", 50).load())
    load = Load(load.name, load.source, load.transform, load.checkpoint, append_to=load.append_to, interval="1 second")
    query = start_load(spark, load)
    try:
        deadline = time.time() + 60
        while not any(p["numInputRows"] > 0 for p in query.recentProgress) and time.time() < deadline:
            time.sleep(0.2)
        assert query.isActive and query.name == "rate-load"
    finally:
        query.stop()
    assert spark.read.parquet(load.append_to).count() > 0


def test_partitioned_sink_rebalances_by_partition(spark, tmp_path):
    load = append(
        "daily",
        tmp_path,
        lambda s: view(s, SF, "pay_feed", streaming=True),
        to_detail(PAYMENTS, AS_OF),
        PAYMENTS.partition,
    )
    query = start_load(spark, load, bounded=True)
    query.awaitTermination()
    plan = query._jsq.explainInternal(False)
    assert "REBALANCE_PARTITIONS_BY_COL" in plan and "Python" not in plan
    written = spark.read.parquet(load.append_to)
    assert written.schema["pt_created_date"].dataType.simpleString() == "int"


def test_detail_upsert_stream_keeps_first_creation(spark, tmp_path):
    """Two days of changes to the same keys: the creation stamp stays, the update stamp moves."""
    raw = spark.createDataFrame([], TRANSACTION_DETAILS.source_schema).schema.add(ROW_KIND, "string")
    source = str(tmp_path / "ods")
    target = keyed_target(
        TRANSACTION_DETAILS, str(tmp_path / "table"), seq=("payment_id",), keep_first_create=True
    )

    def load(transform):
        return Load(
            "details",
            lambda s: scan(s, source, raw, streaming=True),
            transform,
            str(tmp_path / "ckpt"),
            upsert_into=target,
        )

    stamps = [AS_OF.replace(day=day) for day in (1, 2)]
    for version, stamp in enumerate(stamps):
        rows = spark.range(3).selectExpr("CAST(id AS STRING) AS Id", f"{version}L AS PaymentId", "20240101 AS pt_created_date", "'+U' AS _row_kind")
        for field in raw:
            if field.name not in rows.columns:
                rows = rows.withColumn(field.name, F.lit(None).cast(field.dataType))
        rows.select(*raw.names).write.mode("append").parquet(source)
        run_loads(spark, [load(to_detail(TRANSACTION_DETAILS, stamp, carry=(ROW_KIND,)))], bounded=True)
    found = {(r.payment_id, r.dwd_create_at, r.dwd_update_at) for r in read_current(target.read(spark)).collect()}
    assert found == {(1, stamps[0], stamps[1])}


def test_views_stream_equals_batch(spark, tmp_path):
    load = append(
        "views",
        tmp_path,
        lambda s: table_rows(s, SF, "events", streaming=True),
        lambda events: page_views_per_minute(events, lateness="10 minutes"),
    )
    run_loads(spark, [load], bounded=True)
    streamed = spark.read.parquet(load.append_to)
    batch = page_views_per_minute(table_rows(spark, SF, "events"))
    last_closed = streamed.agg(F.max("minute")).first()[0]
    assert same_rows(streamed, batch.filter(F.col("minute") <= F.lit(last_closed)))
