"""Read a keyed table as a stream: what it holds, then what changes, with no gap and no repeat."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lakestrata.operators.staging import claimed, finish_swap
from lakestrata.operators.upsert import UpsertTarget
from lakestrata.operators.versions import DELETE, UPDATE_BEFORE
from lakestrata.sources import files as fs
from lakestrata.sources.readers import partition_filter, partition_values

_TOP = "_top"


@dataclass(frozen=True)
class Follower:
    """A named reader of a keyed table and of the log of all its changes.

    ``log`` streams the changes from the log's beginning; a change may get into
    the table before or after it gets into the log. The checkpoint is the
    reader's identity. ``out`` is where its rows go, a folder per batch.
    """

    name: str
    table: UpsertTarget
    log: Callable[[SparkSession], DataFrame]
    checkpoint: str
    out: str
    interval: str = "2 minutes"


def follow(spark: SparkSession, reader: Follower, bounded: bool = False) -> StreamingQuery:
    """Start the reader, or go on where it stopped.

    At its first start it copies the table, between two swaps of its writers, and
    gives out the live rows. The copy's keys and sequences are the hand-over:
    then the log is read from its beginning, and a change is given out when its
    key is not in the copy or its sequence is newer. Before-images are not given
    out. A change whose sequence is newer than all of its partition in the copy
    needs no look-up, so once the log has passed the copy no batch reads it; the
    others look at the keys of the batch's own partitions only. A batch that is
    run again writes the same folder again.
    """
    copy = f"{reader.checkpoint.rstrip('/')}.copy"
    table = reader.table
    if not fs.exists(spark, f"{copy}/done"):
        with claimed(spark, table.table):
            finish_swap(spark, table.table)
            table.read(spark).write.mode("overwrite").partitionBy(table.partition).parquet(f"{copy}/rows")
        held = _copied(spark, reader, copy)
        tops = held.groupBy(table.partition).agg(F.max(_version(table)).alias(_TOP))
        tops.coalesce(1).write.mode("overwrite").parquet(f"{copy}/tops")
        live = held.filter(~F.col(table.kind).eqNullSafe(DELETE))
        live.write.mode("overwrite").parquet(f"{reader.out}/batch=snapshot")
        fs.write_text(spark, f"{copy}/done", reader.name)

    def give_out(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        fresh = not_in_copy(session, reader, copy, batch)
        fresh.write.mode("overwrite").parquet(f"{reader.out}/batch={batch_id}")

    rows = reader.log(spark).select(*table.schema.names)
    writer = rows.writeStream.queryName(reader.name).option("checkpointLocation", reader.checkpoint)
    writer = writer.trigger(availableNow=True) if bounded else writer.trigger(processingTime=reader.interval)
    return writer.foreachBatch(give_out).start()


def not_in_copy(spark: SparkSession, reader: Follower, copy: str, batch: DataFrame) -> DataFrame:
    """The changes of a batch that the copy does not have yet, and nothing newer either."""
    table = reader.table
    changes = batch.filter(~F.col(table.kind).eqNullSafe(UPDATE_BEFORE))
    # One row per partition.
    tops = F.broadcast(spark.read.parquet(f"{copy}/tops").withColumnRenamed(table.partition, "_partition"))
    marked = changes.join(tops, F.col(table.partition).eqNullSafe(F.col("_partition")), "left").drop("_partition")
    passed = F.col(_TOP).isNull() | (_version(table) > F.col(_TOP))
    sure = marked.filter(passed).drop(_TOP)
    unsure = marked.filter(~passed).drop(_TOP)
    touched = partition_values(unsure.select(table.partition))
    if not touched:
        return sure
    held = _copied(spark, reader, copy).filter(partition_filter(table.partition, touched))
    held = held.select(*[F.col(k).alias(f"_held_{i}") for i, k in enumerate(table.keys)], _version(table).alias("_held"))
    same = F.lit(True)
    for i, key in enumerate(table.keys):
        same = same & F.col(key).eqNullSafe(F.col(f"_held_{i}"))
    looked = unsure.join(held, same, "left")
    new = looked.filter(F.col("_held").isNull() | (_version(table) > F.col("_held")))
    return sure.unionByName(new.select(*changes.columns))


def given_out(spark: SparkSession, reader: Follower) -> DataFrame:
    """All that the reader gave out so far."""
    return spark.read.schema(reader.table.schema).parquet(f"{reader.out}/batch=*")


def _copied(spark: SparkSession, reader: Follower, copy: str) -> DataFrame:
    return spark.read.schema(reader.table.schema).parquet(f"{copy}/rows").select(*reader.table.schema.names)


def _version(table: UpsertTarget):
    return F.struct(*[F.col(c).alias(f"v{i}") for i, c in enumerate(table.seq)])
