"""The registered queries: every operator run over the whole test tables."""

from __future__ import annotations

import datetime as dt
import uuid
from collections import Counter
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, IntegerType, LongType, StringType, StructField, StructType

from lakestrata.operators import (
    UpsertTarget,
    append_changes,
    apply_changes,
    backfill,
    compact_in_place,
    compact_partitions,
    conform_with_rejects,
    drop_expired_partitions,
    expire_partitions,
    keyed_table,
    latest_by_key,
    purge_deletes,
    read_current,
    run_backfill,
    upkeep,
    upsert,
)
from lakestrata.operators.versions import ROW_KIND
from lakestrata.plans.ewallet import PAYMENTS, TRANSACTION_DETAILS, keyed_target, to_detail
from lakestrata.plans.graph import MODELS, Model, run_graph
from lakestrata.plans.models import run_model, success_transactions
from lakestrata.plans.ratings import bets, no_bets
from lakestrata.plans.views import late_minutes
from lakestrata.plans.views import page_views_per_minute as views_per_minute
from lakestrata.session import work_dir
from lakestrata.sources import files as fs
from lakestrata.sources.readers import Sources, scan, set_modified
from lakestrata.sources.tables import Keyed, create_database, create_table, create_table_as, evolve_table, insert_into
from lakestrata.sources.testviews import table_rows, table_schema, view, view_of
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
    run_loads,
    run_shared,
    start_load,
)

# Fixed so that a query and its check stamp the same time.
AS_OF = dt.datetime(2024, 1, 1)
EXPIRY_AS_OF = dt.date(2005, 10, 1)
FEED_EXPIRY_AS_OF = dt.date(2034, 1, 10)
SETTLED_DAY = 20240115
DELETED_DAY = 20240107
DATABASE = "lakestrata_dwd"
FEED_KEYS = ("id", "pt_created_date")
FEED_SCHEMA = (
    StructType()
    .add("id", LongType())
    .add("seq", LongType())
    .add("row_kind", StringType())
    .add("amount", DecimalType(38, 10))
    .add("status", StringType())
    .add("pt_created_date", IntegerType())
)

payments = to_detail(PAYMENTS, AS_OF)
transaction_details = to_detail(TRANSACTION_DETAILS, AS_OF)
detail_changes = to_detail(TRANSACTION_DETAILS, AS_OF, carry=(ROW_KIND,))
SEQ = "_seq"
PAYMENT_KEYED = Keyed(seq=(SEQ,), fields=(StructField(SEQ, LongType()),))
payment_changes = to_detail(PAYMENTS, AS_OF, carry=(SEQ, ROW_KIND))
# Batches of the events out of order: the newest row of a key may be in any of them.
BATCHES = (2, 0, 3, 1)


def dwd_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return payments(view(spark, sf_dir, "pay"))


def dwd_transaction_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transaction_details(view(spark, sf_dir, "txn"))


def unpivot_bets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bets(view(spark, sf_dir, "wide"))


def no_bet_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return no_bets(view(spark, sf_dir, "wide"))


def newest_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_by_key(view(spark, sf_dir, "feed"), FEED_KEYS, "seq")


def merged_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A snapshot of the after-images, and the whole change log merged over it."""
    feed = view(spark, sf_dir, "feed")
    after_images = feed.filter(F.col("row_kind").isin("+I", "+U"))
    snapshot = latest_by_key(after_images, FEED_KEYS, "seq")
    return read_current(apply_changes(snapshot, feed, FEED_KEYS, "seq", kind="row_kind"), "row_kind")


def key_across_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids that live in several partitions: each keeps a row of its own in each of them."""
    feed = view(spark, sf_dir, "feed")
    current = read_current(apply_changes(None, feed, FEED_KEYS, "seq", kind="row_kind"), "row_kind")
    per_id = current.groupBy("id").agg(
        F.count("*").alias("partitions"),
        F.min("pt_created_date").alias("first_partition"),
        F.max("pt_created_date").alias("last_partition"),
    )
    return per_id.filter("partitions > 1")


def change_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = work_dir(spark, "change-log")
    append_changes(view(spark, sf_dir, "feed"), log, "pt_created_date")
    return spark.read.parquet(log)


def _fresh_table(spark: SparkSession, purpose: str) -> tuple[str, str]:
    """A table name not in use yet, and a shared folder for it."""
    create_database(spark, DATABASE, work_dir(spark, DATABASE))
    return f"{DATABASE}.{purpose}_{uuid.uuid4().hex[:12]}", work_dir(spark, purpose)


def table_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Create the partitioned, bucketed table twice, insert once, read back."""
    name, location = _fresh_table(spark, "payments")
    for _ in range(2):
        create_table(spark, PAYMENTS, name, location, bucketed=True)
    insert_into(payments(view(spark, sf_dir, "pay_feed")), name, PAYMENTS.partition)
    return spark.table(name)


def create_table_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second CTAS finds the table there and leaves its rows."""
    name, location = _fresh_table(spark, "nobet")
    hands = no_bet_rows(spark, sf_dir)
    create_table_as(spark, name, hands, location)
    create_table_as(spark, name, hands.filter("box_number IS NULL"), location)
    return spark.table(name)


def _batch(rows: DataFrame, seq: str, i: int) -> DataFrame:
    return rows.filter(F.col(seq) % len(BATCHES) == i)


def upsert_transaction_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The detail table kept as one row per key: batches out of order, by either merge, the first one again."""
    target = keyed_target(TRANSACTION_DETAILS, f"{work_dir(spark, 'details')}/table", seq=("payment_id",))
    changes = detail_changes(view(spark, sf_dir, "txn_feed"))
    for n, i in enumerate((*BATCHES, BATCHES[0])):
        by_join = replace(target, broadcast_bytes=0)
        upsert(spark, by_join if n % 2 else target, _batch(changes, "payment_id", i))
    return read_current(target.read(spark))


def upsert_twice_same_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two different batches by jobs of one name, compactions of one name between them, the first batch replayed."""
    target = feed_target(f"{work_dir(spark, 'feed')}/table")
    feed = view(spark, sf_dir, "feed")
    halves = [feed.filter(F.col("seq") % 2 == i) for i in (1, 0)]
    for rows in (*halves, halves[0]):
        upsert(spark, target, rows)
        compact_in_place(spark, target.path, target.partition, min_files=2, table=target.table)
    return read_current(target.read(spark), "row_kind")


def upsert_by_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table cut into buckets by id, merged in several batches and purged: only buckets with a changed key are written."""
    target = replace(feed_target(f"{work_dir(spark, 'buckets')}/table"), bucket_by=("id",), buckets=4)
    feed = view(spark, sf_dir, "feed")
    for i in BATCHES:
        upsert(spark, target, _batch(feed, "seq", i))
    purge_deletes(spark, target, F.col("pt_created_date") <= SETTLED_DAY)
    compact_in_place(spark, target.path, target.partition, min_files=2, table=target.table)
    return target.read(spark)


def _append_load(spark: SparkSession, sf_dir: str, raw: str, transform, folder: str, partition=None) -> Load:
    return Load(
        name=f"{raw}-{uuid.uuid4().hex[:8]}",
        source=lambda session: view(session, sf_dir, raw, streaming=True),
        transform=transform,
        checkpoint=f"{folder}/checkpoint",
        append_to=f"{folder}/rows",
        partition=partition,
    )


def stream_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = work_dir(spark, "stream-payments")
    load = _append_load(spark, sf_dir, "pay_feed", payments, folder, PAYMENTS.partition)
    run_loads(spark, [load], bounded=True)
    return spark.read.parquet(load.append_to)


def resumed_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same load started twice: the second start goes on from the checkpoint and adds nothing."""
    load = _append_load(spark, sf_dir, "feed", lambda feed: feed, work_dir(spark, "resumed"))
    for _ in range(2):
        run_loads(spark, [load], bounded=True)
    return spark.read.parquet(load.append_to)


def stream_unpivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    load = _append_load(spark, sf_dir, "wide", bets, work_dir(spark, "stream-bets"))
    # The raw rows are evened out: as wide ones they would take several times the bytes.
    load = replace(load, source=lambda session: view(session, sf_dir, "wide", streaming=True, even=True), even=True)
    run_loads(spark, [load], bounded=True)
    return spark.read.parquet(load.append_to)


def _event_files(spark: SparkSession, sf_dir: str, folder: str, batches) -> None:
    """The events as files that arrived one after the other, each batch in a folder of its own."""
    events = table_rows(spark, sf_dir, "events")
    for i in batches:
        _batch(events, "event_id", i).write.parquet(f"{folder}/batch-{i}")


def _raw_event_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The event files as a stream that takes a batch at a time, by however many tasks it was written.

    A batch of the stream costs a merge into the whole table, so their number must
    not grow with the number of files.
    """
    files = Counter(name.partition("/")[0] for name in fs.data_files(spark, folder))
    most = max(files.values(), default=1)
    return scan(spark, f"{folder}/batch-*", table_schema("events"), streaming=True, max_files_per_batch=most)


def _event_stream(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return view_of(_raw_event_stream(spark, folder), name)


def late_file_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load over several files; one that arrives after the first start has a time stamp 30 days old."""
    folder = work_dir(spark, "late")
    load = Load(
        name=f"late-{uuid.uuid4().hex[:8]}",
        source=lambda session: _event_stream(session, f"{folder}/raw", "feed"),
        transform=lambda feed: feed,
        checkpoint=f"{folder}/checkpoint",
        append_to=f"{folder}/rows",
    )
    _event_files(spark, sf_dir, f"{folder}/raw", BATCHES[:-1])
    run_loads(spark, [load], bounded=True)
    _event_files(spark, sf_dir, f"{folder}/raw", BATCHES[-1:])
    set_modified(spark, f"{folder}/raw/batch-{BATCHES[-1]}", "*.parquet", 30)
    run_loads(spark, [load], bounded=True)
    return spark.read.parquet(load.append_to)


def _keyed_load(folder: str, raw: str, transform, target: UpsertTarget) -> Load:
    """A load of the event files in ``folder``, a batch of them at a time, merged by key."""
    return Load(
        name=f"{raw}-{uuid.uuid4().hex[:8]}",
        source=lambda session: _event_stream(session, f"{folder}/raw", raw),
        transform=transform,
        checkpoint=f"{folder}/checkpoint-{raw}",
        upsert_into=target,
    )


def _payments_target(spark: SparkSession) -> UpsertTarget:
    """The payments table in the catalog, with its key, buckets and options."""
    name, location = _fresh_table(spark, "payments")
    create_table(spark, PAYMENTS, name, location, bucketed=True, keyed=PAYMENT_KEYED)
    return keyed_table(spark, name)


def stream_payments_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = work_dir(spark, "payments-keyed")
    _event_files(spark, sf_dir, f"{folder}/raw", BATCHES)
    target = _payments_target(spark)
    run_loads(spark, [_keyed_load(folder, "pay_feed", payment_changes, target)], bounded=True)
    return read_current(target.read(spark), hide=(SEQ,))


def multi_sink_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both detail tables loaded side by side, each merged by its key."""
    folder = work_dir(spark, "multi")
    _event_files(spark, sf_dir, f"{folder}/raw", BATCHES)
    paid = _payments_target(spark)
    detailed = keyed_target(TRANSACTION_DETAILS, f"{folder}/details", seq=("payment_id",))
    loads = [
        _keyed_load(folder, "pay_feed", payment_changes, paid),
        _keyed_load(folder, "txn_feed", detail_changes, detailed),
    ]
    run_loads(spark, loads, bounded=True)
    sinks = {"payments": paid, "transaction_details": detailed}
    rows = [
        read_current(target.read(spark)).select(
            F.lit(sink).alias("sink"), F.col("id").cast("string").alias("id"), "amount", "pt_created_date"
        )
        for sink, target in sinks.items()
    ]
    return rows[0].unionByName(rows[1])


def keyed_table_life(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A keyed table of the catalog through upserts, a purge of settled deletes, expiry and compaction."""
    target = _payments_target(spark)
    changes = payment_changes(view(spark, sf_dir, "pay_feed"))
    for n, i in enumerate(BATCHES):
        upsert(spark, target, _batch(changes, SEQ, i))
        if n == 1:
            upkeep(spark, target.name, FEED_EXPIRY_AS_OF)
    purge_deletes(spark, target, F.col("pt_created_date") <= SETTLED_DAY)
    upkeep(spark, target.name, FEED_EXPIRY_AS_OF)
    by_folder = spark.read.schema(target.schema).parquet(target.path)
    return target.read(spark).withColumn("read_by", F.lit("catalog")).unionByName(
        by_folder.withColumn("read_by", F.lit("folder"))
    )


def feed_target(path: str) -> UpsertTarget:
    return UpsertTarget(path, FEED_SCHEMA, FEED_KEYS, ("seq",), "pt_created_date", kind="row_kind")


def stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = work_dir(spark, "stream-upsert")
    _event_files(spark, sf_dir, f"{folder}/raw", BATCHES)
    target = feed_target(f"{folder}/table")
    run_loads(spark, [_keyed_load(folder, "feed", lambda feed: feed, target)], bounded=True)
    return read_current(target.read(spark), "row_kind")


def stream_transaction_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole path of a detail table: raw stream, conformed, merged by key."""
    folder = work_dir(spark, "stream-details")
    _event_files(spark, sf_dir, f"{folder}/raw", BATCHES)
    target = keyed_target(TRANSACTION_DETAILS, f"{folder}/table", seq=("payment_id",))
    run_loads(spark, [_keyed_load(folder, "txn_feed", detail_changes, target)], bounded=True)
    return read_current(target.read(spark))


def snapshot_then_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A reader that starts in the middle of a load: what the table holds, then the log's changes, folded together."""
    folder = work_dir(spark, "follow")
    feed, target, log = view(spark, sf_dir, "feed"), feed_target(f"{folder}/table"), f"{folder}/log"
    reader = Follower(
        name=f"reader-{uuid.uuid4().hex[:8]}",
        table=target,
        log=lambda session: scan(session, log, FEED_SCHEMA, streaming=True),
        checkpoint=f"{folder}/checkpoint",
        out=f"{folder}/out",
    )
    batches = [_batch(feed, "seq", i) for i in BATCHES]
    for rows in batches[:2]:
        upsert(spark, target, rows)
        append_changes(rows, log, target.partition)
    # The third batch is in the table and not in the log yet when the reader starts.
    upsert(spark, target, batches[2])
    follow(spark, reader, bounded=True).awaitTermination()
    append_changes(batches[2], log, target.partition)
    follow(spark, reader, bounded=True).awaitTermination()
    # The fourth gets into the log first.
    append_changes(batches[3], log, target.partition)
    upsert(spark, target, batches[3])
    follow(spark, reader, bounded=True).awaitTermination()
    return read_current(apply_changes(None, given_out(spark, reader), FEED_KEYS, "seq", kind="row_kind"), "row_kind")


def shared_position_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three sinks fed from one position; the job is lost between two of them, and started again."""
    folder = work_dir(spark, "shared")
    _event_files(spark, sf_dir, f"{folder}/raw", BATCHES)
    paid = _payments_target(spark)
    detailed = keyed_target(TRANSACTION_DETAILS, f"{folder}/details", seq=("payment_id",))
    losses = iter([False, True])

    def details(rows: DataFrame) -> DataFrame:
        if next(losses, False):
            raise RuntimeError("lost between two sinks")
        return detail_changes(view_of(rows, "txn_feed"))

    log = Sink("log", lambda rows: view_of(rows, "feed"), append_to=f"{folder}/log")
    load = SharedLoad(
        name=f"shared-{uuid.uuid4().hex[:8]}",
        source=lambda session: _raw_event_stream(session, f"{folder}/raw"),
        sinks=(
            Sink("payments", lambda rows: payment_changes(view_of(rows, "pay_feed")), upsert_into=paid),
            Sink("transaction_details", details, upsert_into=detailed),
            log,
        ),
        checkpoint=f"{folder}/checkpoint",
    )
    try:
        run_shared(spark, load)
    except StreamingQueryException:
        run_shared(spark, load)
    held = {"payments": read_current(paid.read(spark)), "transaction_details": read_current(detailed.read(spark))}
    held["log"] = read_sink(spark, log)
    rows = [
        kept.select(F.lit(sink).alias("sink"), F.col("id").cast("string").alias("id"), "amount", "pt_created_date")
        for sink, kept in held.items()
    ]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


def expired_readers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of a source once an idle reader has expired and files that the others have read are deleted."""
    folder = work_dir(spark, "readers")
    names = {name: f"{folder}/{name}" for name in ("idle", "live")}

    def load(name: str) -> Load:
        return Load(
            name=name,
            source=lambda session: _event_stream(session, f"{folder}/raw", "feed"),
            transform=lambda feed: feed.select("id"),
            checkpoint=names[name],
            append_to=f"{folder}/{name}-rows",
        )

    with positions_kept(spark, f"{folder}/positions", names):
        _event_files(spark, sf_dir, f"{folder}/raw", BATCHES[:1])
        run_loads(spark, [load("idle")], bounded=True)
        between = dt.datetime.now(dt.UTC)
        _event_files(spark, sf_dir, f"{folder}/raw", BATCHES[1:3])
        run_loads(spark, [load("live")], bounded=True)
    _event_files(spark, sf_dir, f"{folder}/raw", BATCHES[3:])
    expire_readers(spark, f"{folder}/positions", idle=dt.timedelta(0), as_of=between)
    clean_source(spark, f"{folder}/positions")
    left = spark.read.schema(table_schema("events")).option("recursiveFileLookup", "true").parquet(f"{folder}/raw")
    return view_of(left, "feed")


def rejected_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payments that come as text, some of it broken: rows that fit, and values that do not."""
    raw = view(spark, sf_dir, "pay_feed")
    text = raw.select("_seq", *[F.col(c).cast("string").alias(c) for c in PAYMENTS.mapping.values()])
    broken = {
        "Id": F.when(F.col("_seq") % 50 == 7, F.concat(F.lit("x"), "Id")),
        "Amount": F.when(F.col("_seq") % 60 == 11, F.lit("n/a")),
        "CreatedTime": F.when(F.col("_seq") % 70 == 13, F.lit("2024-13-45 00:00:00")),
    }
    text = text.withColumns({c: F.coalesce(value, F.col(c)) for c, value in broken.items()})
    place = work_dir(spark, "checked")
    good, bad = conform_with_rejects(
        text, PAYMENTS.mapping, PAYMENTS.schema, PAYMENTS.partition, place, PAYMENTS.audit, AS_OF, carry=("_seq",)
    )
    none = {name: F.lit(None).cast("string") for name in ("column", "raw_value", "reason")}
    fits = good.select("_seq", "id", "amount", "created_time", *[c.alias(name) for name, c in none.items()])
    seq = F.get_json_object("raw_row", "$._seq").cast("long").alias("_seq")
    empty = [F.lit(None).cast(PAYMENTS.schema[c].dataType).alias(c) for c in ("id", "amount", "created_time")]
    return fits.unionByName(bad.select(seq, *empty, *none))


def table_spec_grows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows written before and after the table got four more columns."""
    name, location = _fresh_table(spark, "growing")
    smaller = replace(PAYMENTS, columns=PAYMENTS.columns[:-4], expire_days=100)
    raw = view(spark, sf_dir, "pay_feed")
    create_table(spark, smaller, name, location, bucketed=True)
    insert_into(to_detail(smaller, AS_OF)(_batch_of(raw, 0)), name, PAYMENTS.partition)
    evolve_table(spark, PAYMENTS, name, bucketed=True)
    insert_into(payments(_batch_of(raw, 1)), name, PAYMENTS.partition)
    return spark.table(name).select(*PAYMENTS.schema.names)


def _batch_of(rows: DataFrame, odd: int) -> DataFrame:
    return rows.filter(F.col(SEQ) % 2 == odd)


# Views arrive up to four days out of order; some of the first two days come after all others.
VIEW_LATENESS = "6 days"
VIEWS_HELD_BACK = "event_id % 97 = 5 AND day(ts) <= 2"


def stream_page_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The views of the minutes that are closed, counted by a stream that is stopped and started again between files."""
    folder = work_dir(spark, "stream-views")
    events = table_rows(spark, sf_dir, "events").withColumn("held", F.expr(VIEWS_HELD_BACK))
    chunk = F.expr("CAST((day(ts) + event_id % 5) / 8 AS INT)")

    def arrive(name: str, rows: DataFrame) -> None:
        rows.drop("held").coalesce(1).write.parquet(f"{folder}/raw/batch-{name}")

    late = 0
    for first, last in ((0, 1), (2, 9)):
        for at in range(first, min(last, 4) + 1):
            arrive(str(at), events.filter(~F.col("held") & (chunk == at)))
        if last == 9:
            arrive("held", events.filter("held"))
        load = Load(
            name=f"views-{uuid.uuid4().hex[:8]}",
            source=lambda session: scan(
                session, f"{folder}/raw/batch-*", table_schema("events"), streaming=True, max_files_per_batch=1
            ),
            transform=lambda rows: views_per_minute(rows, lateness=VIEW_LATENESS),
            checkpoint=f"{folder}/checkpoint",
            append_to=f"{folder}/rows",
        )
        query = start_load(spark, load, bounded=True)
        query.awaitTermination()
        late += late_minutes(query)
    return spark.read.parquet(f"{folder}/rows").withColumn("late_minutes", F.lit(late).cast("long"))


def resumed_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History loaded range by range, stopped after two ranges and started again."""
    folder = work_dir(spark, "ranges")
    stored = payments(view(spark, sf_dir, "pay_feed")).hint("rebalance", PAYMENTS.partition)
    stored.write.partitionBy(PAYMENTS.partition).parquet(f"{folder}/history")

    def write(rows: DataFrame, number: int) -> None:
        rows.write.mode("overwrite").parquet(f"{folder}/loaded/range={number}")

    for most in (2, None):
        run_backfill(spark, f"{folder}/history", PAYMENTS.partition, f"{folder}/book", write, ["id"], 100_000, most)
    return spark.read.parquet(f"{folder}/loaded").drop("range")


def spending_models() -> list[Model]:
    """Three models, each over the one before."""

    def user_totals(source: Sources) -> DataFrame:
        paid = source(MODELS, "success")
        return paid.groupBy("user_id").agg(F.count("*").alias("payments"), F.sum("amount").alias("amount"))

    def spending_bands(source: Sources) -> DataFrame:
        band = F.floor(F.col("amount") / 500).cast("int").alias("band")
        return source(MODELS, "user_totals").groupBy(band).agg(
            F.count("*").alias("users"), F.sum("payments").alias("payments")
        )

    return [
        Model("spending_bands", ((MODELS, "user_totals"),), spending_bands, layer="dwd"),
        Model("success", (("ods", "ewallet_transaction_details"),), success_transactions(AS_OF), layer="dwd"),
        Model("user_totals", ((MODELS, "success"),), user_totals, layer="dwd"),
    ]


def model_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    database = f"{DATABASE}_{uuid.uuid4().hex[:12]}"
    create_database(spark, database, work_dir(spark, database))
    relations = {("ods", "ewallet_transaction_details"): view(spark, sf_dir, "model_src")}
    run_graph(spark, spending_models(), relations, database).raise_failures()
    return spark.table(f"{database}.spending_bands")


def purged_deletes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored rows, deletes included, once those of the first half month are settled.

    One day has nothing but deletes, and is dropped.
    """
    target = feed_target(f"{work_dir(spark, 'purged')}/table")
    feed = view(spark, sf_dir, "feed")
    upsert(spark, target, feed.filter((F.col("row_kind") == "-D") | (F.col("pt_created_date") != DELETED_DAY)))
    purge_deletes(spark, target, F.col("pt_created_date") <= SETTLED_DAY)
    return target.read(spark)


def kept_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return expire_partitions(dwd_payments(spark, sf_dir), PAYMENTS.partition, as_of=EXPIRY_AS_OF)


def dropped_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored table after its expired partitions were dropped."""
    name, location = _fresh_table(spark, "expiring")
    create_table(spark, PAYMENTS, name, location)
    insert_into(payments(view(spark, sf_dir, "pay_feed")), name, PAYMENTS.partition)
    drop_expired_partitions(
        spark, name, PAYMENTS.partition, PAYMENTS.partition_format, PAYMENTS.expire_days, FEED_EXPIRY_AS_OF
    )
    return spark.table(name)


def _fragmented_log(spark: SparkSession, sf_dir: str, folder: str) -> str:
    """The feed as a load without a rebalance leaves it: a file per task and day, twice."""
    feed = view(spark, sf_dir, "feed")
    deletes = F.col("row_kind").eqNullSafe("-D")
    for rows in (feed.filter(~deletes), feed.filter(deletes)):
        rows.write.mode("append").partitionBy("pt_created_date").parquet(f"{folder}/log")
    return f"{folder}/log"


def compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = work_dir(spark, "compacted")
    log = _fragmented_log(spark, sf_dir, folder)
    compact_partitions(spark, log, f"{folder}/large", "pt_created_date")
    return spark.read.parquet(f"{folder}/large")


def compacted_in_place(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = work_dir(spark, "compacted-in-place")
    log = _fragmented_log(spark, sf_dir, folder)
    compact_in_place(spark, log, "pt_created_date", min_files=2)
    return spark.read.parquet(log)


def compact_two_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log partitioned by day and kind, compacted in place and then to another folder."""
    folder = work_dir(spark, "two-levels")
    feed = view(spark, sf_dir, "feed").withColumn("hour", F.format_string("%02d", F.col("seq") % 4))
    for rows in (feed.filter("seq % 2 = 0"), feed.filter("seq % 2 = 1")):
        rows.repartition(3).write.mode("append").partitionBy("pt_created_date", "hour").parquet(f"{folder}/log")
    compact_in_place(spark, f"{folder}/log", "pt_created_date", min_files=2)
    compact_partitions(spark, f"{folder}/log", f"{folder}/large", "pt_created_date")
    schema = StructType([*FEED_SCHEMA.fields[:-1], StructField("pt_created_date", IntegerType()), StructField("hour", StringType())])
    return spark.read.schema(schema).parquet(f"{folder}/large")


def compact_while_loading(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A change log that is appended to and compacted at the same time, by two threads."""
    log = f"{work_dir(spark, 'busy-log')}/log"
    feed = view(spark, sf_dir, "feed")
    append_changes(_batch(feed, "seq", BATCHES[0]), log, "pt_created_date")
    with ThreadPoolExecutor(2) as pool:
        loading = pool.submit(lambda: [append_changes(_batch(feed, "seq", i), log, "pt_created_date") for i in BATCHES[1:]])
        session = spark.newSession()
        while not loading.done():
            compact_in_place(session, log, "pt_created_date", min_files=2)
        loading.result()
    compact_in_place(spark, log, "pt_created_date", min_files=2)
    return spark.read.parquet(log)


def backfill_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return backfill(dwd_payments(spark, sf_dir), "pt_created_date", ["id"])


def model_success_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    name, location = _fresh_table(spark, "success")
    sources = Sources(
        spark, {("ods", "ewallet_transaction_details"): view(spark, sf_dir, "model_src")}
    )
    return run_model(
        spark,
        name,
        sources,
        success_transactions(AS_OF),
        layer="dwd",
        keys=["transaction_id"],
        distributed_by=["transaction_id"],
        buckets=4,
        location=location,
    )


def model_as_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    sources = Sources(
        spark, {("ods", "ewallet_transaction_details"): view(spark, sf_dir, "model_src")}
    )
    return run_model(spark, "success_transactions", sources, success_transactions(AS_OF), layer="ods")


def page_views_per_minute(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views_per_minute(table_rows(spark, sf_dir, "events"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "dwd_payments": dwd_payments,
    "dwd_transaction_details": dwd_transaction_details,
    "unpivot_bets": unpivot_bets,
    "no_bet_rows": no_bet_rows,
    "latest_by_key": newest_per_key,
    "apply_changes": merged_feed,
    "key_across_partitions": key_across_partitions,
    "append_changes": change_log,
    "table_payments": table_payments,
    "create_table_once": create_table_once,
    "upsert_transaction_details": upsert_transaction_details,
    "stream_payments": stream_payments,
    "stream_unpivot": stream_unpivot,
    "stream_payments_keyed": stream_payments_keyed,
    "late_file_load": late_file_load,
    "upsert_twice_same_name": upsert_twice_same_name,
    "upsert_by_bucket": upsert_by_bucket,
    "keyed_table_life": keyed_table_life,
    "stream_upsert": stream_upsert,
    "stream_transaction_details": stream_transaction_details,
    "multi_sink_load": multi_sink_load,
    "resumed_load": resumed_load,
    "snapshot_then_changes": snapshot_then_changes,
    "shared_position_load": shared_position_load,
    "expired_readers": expired_readers,
    "conform_with_rejects": rejected_values,
    "table_spec_grows": table_spec_grows,
    "stream_page_views": stream_page_views,
    "resumed_backfill": resumed_backfill,
    "model_graph": model_graph,
    "purge_deletes": purged_deletes,
    "expire_partitions": kept_partitions,
    "drop_expired_partitions": dropped_partitions,
    "compact_partitions": compacted,
    "compact_in_place": compacted_in_place,
    "compact_two_levels": compact_two_levels,
    "compact_while_loading": compact_while_loading,
    "backfill_order": backfill_order,
    "model_success_transactions": model_success_transactions,
    "model_as_view": model_as_view,
    "page_views_per_minute": page_views_per_minute,
}
