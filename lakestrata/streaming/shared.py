"""One stream that feeds several sinks from one position."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from lakestrata.operators.upsert import UpsertTarget, upsert
from lakestrata.sources import files as fs


@dataclass(frozen=True)
class Sink:
    """Where a transform of the stream goes: a keyed table, or a folder with a folder per batch."""

    name: str
    transform: Callable[[DataFrame], DataFrame]
    upsert_into: UpsertTarget | None = None
    append_to: str | None = None


@dataclass(frozen=True)
class SharedLoad:
    """A source read once for all its sinks. The checkpoint holds the one position."""

    name: str
    source: Callable[[SparkSession], DataFrame]
    sinks: tuple[Sink, ...]
    checkpoint: str
    interval: str = "2 minutes"


def start_shared(spark: SparkSession, load: SharedLoad, bounded: bool = False) -> StreamingQuery:
    """Start the load; every batch goes to all sinks, in their order, before the position moves on.

    Beside the checkpoint each sink has the number of the last batch that it took
    whole. A batch that was cut off between two sinks is run again with the same
    rows, and the sinks that had it already pass it by. Inside a sink a batch can
    be repeated: a keyed table does not apply a sequence twice, and a folder's
    batch is written over.
    """
    names = [sink.name for sink in load.sinks]
    if len(set(names)) < len(names):
        raise ValueError(f"the sinks of {load.name} need names of their own")
    for sink in load.sinks:
        if (sink.upsert_into is None) == (sink.append_to is None):
            raise ValueError(f"sink {sink.name} of {load.name} needs a table or a folder")

    def feed(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        for sink in load.sinks:
            if taken(session, load, sink.name) < batch_id:
                _write(session, sink, sink.transform(batch), batch_id)
                fs.write_text(session, _place(load, sink.name), str(batch_id))

    writer = load.source(spark).writeStream.queryName(load.name).option("checkpointLocation", load.checkpoint)
    writer = writer.trigger(availableNow=True) if bounded else writer.trigger(processingTime=load.interval)
    return writer.foreachBatch(feed).start()


def run_shared(spark: SparkSession, load: SharedLoad) -> None:
    """Work off what is there now; what fails is raised."""
    start_shared(spark, load, bounded=True).awaitTermination()


def taken(spark: SparkSession, load: SharedLoad, sink: str) -> int:
    """The last batch that a sink took whole; -1 before the first."""
    return int(fs.read_text(spark, _place(load, sink)) or -1)


def positions(spark: SparkSession, load: SharedLoad) -> dict[str, int]:
    return {sink.name: taken(spark, load, sink.name) for sink in load.sinks}


def read_sink(spark: SparkSession, sink: Sink) -> DataFrame:
    """What a folder sink holds, without the batch numbers."""
    return spark.read.parquet(sink.append_to).drop("batch")


def _place(load: SharedLoad, sink: str) -> str:
    return f"{load.checkpoint.rstrip('/')}.sinks/{sink}"


def _write(spark: SparkSession, sink: Sink, rows: DataFrame, batch_id: int) -> None:
    if sink.upsert_into:
        upsert(spark, sink.upsert_into, rows)
    else:
        rows.hint("rebalance").write.mode("overwrite").parquet(f"{sink.append_to}/batch={batch_id}")
