"""Named loads that resume from their checkpoints, run together, and fail together."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from lakestrata.operators.upsert import UpsertTarget, upsert


@dataclass(frozen=True)
class Load:
    """Source, transform and sink of one load.

    The sink is a folder to append to (``append_to``, exactly once) or a keyed
    table (``upsert_into``, repeated batches change nothing). The checkpoint is
    the load's identity: it holds the source position. ``even`` says that the
    source has spread its rows evenly already, where they were smaller.
    """

    name: str
    source: Callable[[SparkSession], DataFrame]
    transform: Callable[[DataFrame], DataFrame]
    checkpoint: str
    append_to: str | None = None
    partition: str | None = None
    upsert_into: UpsertTarget | None = None
    interval: str = "2 minutes"
    even: bool = False


def start_load(spark: SparkSession, load: Load, bounded: bool = False) -> StreamingQuery:
    """Start the load; ``bounded`` works off what is there now and then stops."""
    if (load.append_to is None) == (load.upsert_into is None):
        raise ValueError(f"load {load.name} needs exactly one sink")
    source = load.source(spark)
    if load.append_to and not load.partition and not load.even:
        # Files follow the size of the data and not the input's files or row
        # groups; before the transform, which may make many rows of one.
        source = source.hint("rebalance")
    rows = load.transform(source)
    if load.append_to and load.partition:
        # Without this every task would write a file into every partition it
        # meets; adaptive execution still splits a hot partition.
        rows = rows.hint("rebalance", load.partition)
    writer = rows.writeStream.queryName(load.name).option("checkpointLocation", load.checkpoint)
    writer = writer.trigger(availableNow=True) if bounded else writer.trigger(processingTime=load.interval)
    if load.append_to:
        if load.partition:
            writer = writer.partitionBy(load.partition)
        # What a transform repeats in many rows of one packs better than by the default.
        writer = writer.option("compression", "zstd")
        return writer.format("parquet").outputMode("append").start(load.append_to)

    def merge(batch: DataFrame, batch_id: int) -> None:
        # The stream's own session: what a write sets there no other load sees.
        upsert(batch.sparkSession, load.upsert_into, batch)

    return writer.foreachBatch(merge).start()


def run_loads(
    spark: SparkSession, loads: Sequence[Load], bounded: bool = False, poll_seconds: float = 0.2
) -> None:
    """Run loads side by side until all end; when one fails, stop the others and raise.

    Each load has its own checkpoint, so after a failure the sinks may differ
    by one batch until they are started again.
    """
    queries: list[StreamingQuery] = []
    try:
        for load in loads:
            queries.append(start_load(spark, load, bounded))
        while any(query.isActive for query in queries):
            _raise_failure(queries)
            time.sleep(poll_seconds)
        _raise_failure(queries)
    finally:
        for query in queries:
            query.stop()


def _raise_failure(queries: Sequence[StreamingQuery]) -> None:
    for query in queries:
        failure = query.exception()
        if failure is not None:
            raise failure
