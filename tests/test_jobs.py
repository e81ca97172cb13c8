"""Followers, shared positions, reader expiry, rejects, growing specs, backfills and model graphs."""

from __future__ import annotations

import datetime as dt
import glob
from dataclasses import replace

import pytest
from conftest import SF
from plans import physical, same_rows
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructType

from lakestrata.operators import append_changes, conform_with_rejects, finished_ranges, latest_by_key, run_backfill, upsert
from lakestrata.operators.ranges import cut_ranges
from lakestrata.plans.ewallet import PAYMENTS, to_detail
from lakestrata.plans.graph import MODELS, Model, lineage, run_graph, run_order
from lakestrata.queries import (
    AS_OF,
    FEED_KEYS,
    FEED_SCHEMA,
    PAYMENT_KEYED,
    _raw_event_stream,
    feed_target,
    spending_models,
)
from lakestrata.sources import files as fs
from lakestrata.sources.readers import scan
from lakestrata.sources.tables import create_database, create_table, evolve_table, insert_into
from lakestrata.sources.testviews import table_schema, view
from lakestrata.streaming import (
    Follower,
    Load,
    SharedLoad,
    Sink,
    clean_source,
    expire_readers,
    follow,
    given_out,
    positions_kept,
    read_sink,
    reader_positions,
    run_loads,
    run_shared,
    start_shared,
)
from lakestrata.streaming.follow import not_in_copy
from lakestrata.streaming.shared import positions


@pytest.fixture(scope="module")
def feed(spark):
    return view(spark, SF, "feed").select(*FEED_SCHEMA.names).filter("seq < 4000")


def follower(tmp_path, name="reader"):
    return Follower(
        name=name,
        table=feed_target(str(tmp_path / "table")),
        log=lambda s: scan(s, str(tmp_path / "log"), FEED_SCHEMA, streaming=True),
        checkpoint=str(tmp_path / name),
        out=str(tmp_path / f"{name}-out"),
    )


def test_a_follower_gives_out_each_change_once(spark, tmp_path, feed):
    reader = follower(tmp_path)
    halves = [feed.filter(f"seq % 2 = {i}") for i in range(2)]
    append_changes(halves[0], str(tmp_path / "log"), "pt_created_date")
    upsert(spark, reader.table, halves[0])
    upsert(spark, reader.table, halves[1].filter("seq % 3 = 0"))
    for rows in (None, halves[1].filter("seq % 3 = 0"), halves[1].filter("seq % 3 > 0")):
        if rows is not None:
            append_changes(rows, str(tmp_path / "log"), "pt_created_date")
        follow(spark, reader, bounded=True).awaitTermination()
    out = given_out(spark, reader).select(*FEED_SCHEMA.names)
    assert out.count() == out.select(*FEED_KEYS, "seq").distinct().count()
    # Nothing that counts is missing: the newest row of each key, deletes included, but for keys deleted before the start.
    newest = latest_by_key(feed.filter("row_kind <> '-U'"), FEED_KEYS, "seq")
    missing = newest.join(out, [*FEED_KEYS, "seq"], "left_anti")
    assert missing.filter("row_kind <> '-D'").isEmpty()


def test_a_follower_looks_up_only_partitions_it_has_not_passed(spark, tmp_path, feed):
    reader = follower(tmp_path)
    append_changes(feed, str(tmp_path / "log"), "pt_created_date")
    upsert(spark, reader.table, feed)
    follow(spark, reader, bounded=True).awaitTermination()
    assert sorted(p.rsplit("=", 1)[1] for p in glob.glob(f"{reader.out}/batch=*")) == ["0", "snapshot"]
    assert spark.read.parquet(f"{reader.out}/batch=0").isEmpty()
    copy = f"{reader.checkpoint}.copy"
    newer = feed.withColumn("seq", F.col("seq") + 1_000_000)
    passed = not_in_copy(spark, reader, copy, newer)
    assert "copy/rows" not in "".join(passed.inputFiles())
    assert passed.count() == feed.filter("row_kind <> '-U'").count()
    one_day = not_in_copy(spark, reader, copy, feed.filter("pt_created_date = 20240103"))
    scans = [line for line in physical(one_day).splitlines() if "copy/rows" in line]
    assert scans and all("PartitionFilters: [" in s and "= 20240103" in s.split("PartitionFilters")[1] for s in scans)


def shared(tmp_path, feed_files, details):
    target = feed_target(str(tmp_path / "table"))
    return target, SharedLoad(
        "shared",
        lambda s: scan(s, feed_files, FEED_SCHEMA, streaming=True, max_files_per_batch=1),
        (
            Sink("first", lambda rows: rows, append_to=str(tmp_path / "first")),
            Sink("table", lambda rows: rows, upsert_into=target),
            Sink("last", details, append_to=str(tmp_path / "last")),
        ),
        str(tmp_path / "checkpoint"),
    )


def test_a_job_lost_between_sinks_leaves_no_difference(spark, tmp_path, feed):
    feed_files = str(tmp_path / "raw")
    feed.repartition(3).write.parquet(feed_files)
    turns = iter([False, True])

    def fails_at_the_second_batch(rows):
        if next(turns, False):
            raise RuntimeError("lost")
        return rows

    target, load = shared(tmp_path, feed_files, fails_at_the_second_batch)
    with pytest.raises(StreamingQueryException, match="lost"):
        run_shared(spark, load)
    assert positions(spark, load) == {"first": 1, "table": 1, "last": 0}
    run_shared(spark, load)
    assert set(positions(spark, load).values()) == {2}
    for sink in (load.sinks[0], load.sinks[2]):
        assert same_rows(read_sink(spark, sink).select(*feed.columns), feed)
    newest = latest_by_key(feed.filter("row_kind <> '-U'"), FEED_KEYS, "seq")
    assert same_rows(target.read(spark).select(*newest.columns), newest)
    run_shared(spark, load)
    assert read_sink(spark, load.sinks[0]).count() == feed.count()


def test_a_stream_of_arrivals_takes_one_at_a_time_by_however_many_tasks_it_was_written(spark, tmp_path):
    schema = table_schema("events")
    for at in (1, 0):
        rows = spark.createDataFrame([(2 * n + at, None, 1, "view", 1.0, None) for n in range(12)], schema)
        rows.repartition(3).write.parquet(f"{tmp_path}/raw/batch-{at}")
    assert len(fs.data_files(spark, f"{tmp_path}/raw")) == 6
    taken = []
    stream = _raw_event_stream(spark, f"{tmp_path}/raw").writeStream.trigger(availableNow=True)
    stream = stream.option("checkpointLocation", f"{tmp_path}/checkpoint")
    stream.foreachBatch(lambda rows, _: taken.append(sorted(r["event_id"] for r in rows.collect()))).start().awaitTermination()
    assert taken == [list(range(1, 24, 2)), list(range(0, 24, 2))]


def test_sinks_need_a_place_and_a_name(spark, tmp_path):
    sink = Sink("a", lambda rows: rows, append_to=str(tmp_path / "a"))
    load = SharedLoad("x", lambda s: s.readStream.format("rate").load(), (sink, sink), str(tmp_path / "c"))
    with pytest.raises(ValueError, match="names of their own"):
        start_shared(spark, load)
    with pytest.raises(ValueError, match="a table or a folder"):
        start_shared(spark, replace(load, sinks=(replace(sink, append_to=None),)))


def test_the_slowest_reader_holds_the_files_back(spark, tmp_path):
    raw, place = str(tmp_path / "raw"), str(tmp_path / "positions")
    names = {name: str(tmp_path / name) for name in ("slow", "quick")}
    schema = StructType().add("id", LongType())

    def load(name):
        return Load(
            name, lambda s: scan(s, raw, schema, streaming=True), lambda rows: rows, names[name],
            append_to=str(tmp_path / f"{name}-rows"),
        )

    assert clean_source(spark, place) == 0
    with positions_kept(spark, place, names):
        spark.range(3).coalesce(1).write.parquet(raw)
        run_loads(spark, [load("slow")], bounded=True)
        between = dt.datetime.now(dt.UTC)
        spark.range(3, 8).coalesce(1).write.mode("append").parquet(raw)
        run_loads(spark, [load("quick")], bounded=True)
    spark.range(8, 10).coalesce(1).write.mode("append").parquet(raw)
    assert {r.reader: r.batch for r in reader_positions(spark, place).collect()} == {"slow": 0, "quick": 0}
    assert clean_source(spark, place) == 1
    assert sorted(r.id for r in spark.read.parquet(raw).collect()) == list(range(3, 10))
    assert expire_readers(spark, place, dt.timedelta(days=3)) == []
    assert expire_readers(spark, place, dt.timedelta(0), between) == ["slow"]
    assert clean_source(spark, place) == 1
    assert sorted(r.id for r in spark.read.parquet(raw).collect()) == [8, 9]
    # The reader that is left goes on as if nothing had happened.
    with positions_kept(spark, place, names):
        run_loads(spark, [load("quick")], bounded=True)
    assert spark.read.parquet(str(tmp_path / "quick-rows")).count() == 10


def test_every_row_fits_or_is_put_aside(spark, tmp_path):
    raw = spark.sql(
        "SELECT * FROM VALUES ('1', '2.5', '20240101'), ('x', 'y', '20240101'), (NULL, NULL, '20240102'),"
        " ('3', '1', NULL), ('4', '99999999999999999999', 'day'), ('5', '1e3', '20240103') AS t(A, B, P)"
    )
    schema = StructType().add("a", LongType()).add("b", "decimal(10,2)").add("p", IntegerType())
    good, bad = conform_with_rejects(raw, {"a": "A", "b": "B", "p": "P"}, schema, "p", str(tmp_path / "c"), as_of=AS_OF)
    assert [tuple(r) for r in good.select("a", "p").orderBy("p").collect()] == [(1, 20240101), (None, 20240102), (5, 20240103)]
    found = {(r.column, r.raw_value, r.reason) for r in bad.collect()}
    assert found == {
        ("a", "x", "not bigint"),
        ("b", "y", "not decimal(10,2)"),
        ("p", None, "missing partition"),
        ("b", "99999999999999999999", "not decimal(10,2)"),
        ("p", "day", "not int"),
    }
    assert good.count() + bad.select("raw_row").distinct().count() == raw.count()
    assert '"B":"y"' in bad.filter("raw_value = 'x'").first()["raw_row"]



def test_a_table_grows_or_is_left_alone(spark, tmp_path):
    create_database(spark, "growing", str(tmp_path / "db"))
    smaller = replace(PAYMENTS, columns=PAYMENTS.columns[:-2], expire_days=10)
    create_table(spark, smaller, "growing.payments", str(tmp_path / "t"), bucketed=True, keyed=PAYMENT_KEYED)
    changed = replace(PAYMENTS, columns=(("Ident", "id", LongType()), *PAYMENTS.columns[1:]))
    done = evolve_table(spark, changed, "growing.payments", bucketed=True, keyed=PAYMENT_KEYED)
    assert done == ["column modified_time", "column modified_by", "comment of id", "option partition-expire-days"]
    assert evolve_table(spark, changed, "growing.payments", bucketed=True, keyed=PAYMENT_KEYED) == []
    stored = spark.table("growing.payments").schema
    assert stored["id"].metadata["comment"] == "ODS: Ident" and stored["modified_by"].metadata["comment"] == "ODS: ModifiedBy"
    retyped = tuple((s, c, StringType() if c == "amount" else t) for s, c, t in PAYMENTS.columns[2:])
    with pytest.raises(ValueError, match="column id is gone.*column patron_id is gone.*column amount is string.*bucket-count is 8"):
        evolve_table(spark, replace(PAYMENTS, columns=retyped, buckets=8), "growing.payments", bucketed=True, keyed=PAYMENT_KEYED)
    with pytest.raises(ValueError, match="primary-key is None"):
        evolve_table(spark, changed, "growing.payments", bucketed=True)
    assert spark.table("growing.payments").schema == stored


def test_rows_from_before_and_after_live_together(spark, tmp_path):
    create_database(spark, "growing", str(tmp_path / "db"))
    smaller = replace(PAYMENTS, columns=PAYMENTS.columns[:3])
    create_table(spark, smaller, "growing.plain", str(tmp_path / "plain"))
    raw = view(spark, SF, "pay_feed").limit(50)
    insert_into(to_detail(smaller, AS_OF)(raw), "growing.plain", PAYMENTS.partition)
    before = spark.table("growing.plain").count()
    evolve_table(spark, PAYMENTS, "growing.plain")
    insert_into(to_detail(PAYMENTS, AS_OF)(raw), "growing.plain", PAYMENTS.partition)
    rows = spark.table("growing.plain")
    assert rows.count() == 2 * before and rows.filter("created_time IS NULL").count() == before


def test_ranges_are_cut_by_bytes():
    sizes = [(None, 5), ("1", 50), ("2", 60), ("3", 500), ("4", 1), ("5", 2)]
    assert cut_ranges(sizes, 115) == [[None, "1", "2"], ["3"], ["4", "5"]]
    assert cut_ranges([], 10) == []


def test_a_backfill_that_is_lost_in_a_range_takes_it_again(spark, tmp_path):
    src, book = str(tmp_path / "src"), str(tmp_path / "book")
    rows = spark.range(400).selectExpr("id", "CAST(IF(id % 10 = 9, NULL, 8 + id % 10) AS INT) AS day")
    rows.coalesce(1).write.partitionBy("day").parquet(src)
    taken = []

    def write(part, number, lose=None):
        if number == lose:
            part.limit(3).write.mode("overwrite").parquet(f"{tmp_path}/out/range={number}")
            raise RuntimeError("lost")
        taken.append((number, [r.id for r in part.collect()]))
        part.write.mode("overwrite").parquet(f"{tmp_path}/out/range={number}")

    size = max(s for s in (len(open(f, "rb").read()) for f in glob.glob(f"{src}/*/*.parquet")))
    with pytest.raises(RuntimeError, match="lost"):
        run_backfill(spark, src, "day", book, lambda p, n: write(p, n, lose=2), ["id"], 2 * size)
    assert finished_ranges(spark, book).count() == 2
    # A day that arrives later does not move the ranges of the plan.
    done, of = run_backfill(spark, src, "day", book, write, ["id"], 1)
    assert done == of == 5 and [n for n, _ in taken] == [0, 1, 2, 3, 4]
    days = [None, *range(8, 17)]
    order = [i for pair in range(5) for day in days[2 * pair : 2 * pair + 2] for i in range(400) if (None if i % 10 == 9 else 8 + i % 10) == day]
    assert [i for _, ids in taken for i in ids] == order
    assert same_rows(spark.read.parquet(f"{tmp_path}/out").select("id", "day"), rows)
    assert {(r.first, r.last) for r in finished_ranges(spark, book).collect()} >= {(None, "8"), ("15", "16")}


def simple(name, *parents, build=None):
    reads = tuple((MODELS, p) for p in parents) or (("raw", "ids"),)
    return Model(name, reads, build or (lambda source: source(*reads[0])), options={"materialized": "view"})


def test_models_run_behind_what_they_read(spark):
    def broken(source):
        raise RuntimeError("broken")

    def undeclared(source):
        return source("raw", "other")

    models = [simple("d", "c"), simple("c", "b"), simple("b", "a", build=broken), simple("a"), simple("e", "a"), simple("f", build=undeclared)]
    run = run_graph(spark, models, {("raw", "ids"): spark.range(4), ("raw", "other"): spark.range(1)})
    assert run.states == {"a": "built", "b": "failed", "c": "skipped", "d": "skipped", "e": "built", "f": "failed"}
    assert spark.table("e").count() == 4
    with pytest.raises(ExceptionGroup, match="failed: .*b"):
        run.raise_failures()
    told = {(r.model, r.source, r.steps) for r in lineage(spark, models).collect()}
    assert {("d", "model.a", 3), ("d", "raw.ids", 4), ("e", "model.a", 1), ("a", "raw.ids", 1)} <= told


def test_graphs_that_cannot_run_are_refused(spark):
    with pytest.raises(ValueError, match="circle"):
        run_order([simple("a", "b"), simple("b", "a")])
    with pytest.raises(ValueError, match="no model"):
        run_order([simple("a", "b")])
    with pytest.raises(ValueError, match="one name"):
        run_order([simple("a"), simple("a")])
    assert run_order(spending_models()) == ["success", "user_totals", "spending_bands"]


def test_small_files_of_the_jobs(spark, tmp_path):
    place = str(tmp_path / "deep" / "note")
    assert fs.read_text(spark, place) is None
    fs.write_text(spark, place, "one")
    fs.write_text(spark, place, "two é")
    assert fs.read_text(spark, place) == "two é"
    assert fs.create_new(spark, f"{place}-claim", "x") and not fs.create_new(spark, f"{place}-claim", "y")
    with pytest.raises(Exception, match="moved|FileNotFound"):
        fs.move(spark, f"{place}-none", f"{place}-there")
