"""Keyed tables of the catalog: everything a table needs is read from its own options."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import SparkSession

from lakestrata.operators.maintain import (
    TARGET_FILE_BYTES,
    compact_in_place,
    drop_expired_partitions,
)
from lakestrata.operators.staging import finish_pending
from lakestrata.operators.upsert import UpsertTarget
from lakestrata.sources.readers import table_location, table_options


def keyed_table(spark: SparkSession, name: str) -> UpsertTarget:
    """The table that ``create_table`` made with a key, as a target for upserts, purges and streams."""
    options = table_options(spark, name)
    if not options.get("primary-key"):
        raise ValueError(f"{name} has no key")
    partition = next(c.name for c in spark.catalog.listColumns(name) if c.isPartition)
    return UpsertTarget(
        path=table_location(spark, name),
        schema=spark.table(name).schema,
        keys=tuple(options["primary-key"].split(",")),
        seq=tuple(options["sequence"].split(",")),
        partition=partition,
        kind=options["row-kind"],
        keep_first=tuple(filter(None, options.get("keep-first", "").split(","))),
        name=name,
        bucket_by=tuple(filter(None, options.get("bucket-key", "").split(","))),
        buckets=int(options.get("bucket-count", 0)),
        file_bytes=int(options.get("target-file-bytes", TARGET_FILE_BYTES)),
    )


def upkeep(
    spark: SparkSession, name: str, as_of: dt.date | None = None, tz: str = "UTC", min_files: int = 3
) -> list[str]:
    """Drop what has expired and compact what is fragmented, as the table's options say.

    The values of the dropped partitions are returned.
    """
    options, target = table_options(spark, name), keyed_table(spark, name)
    finish_pending(spark, target.table)
    days = int(options.get("partition-expire-days", 3650))
    fmt = options.get("partition-format", "yyyyMMdd")
    dropped = drop_expired_partitions(spark, name, target.partition, fmt, days, as_of, tz)
    compact_in_place(
        spark, target.path, target.partition, target.file_bytes or TARGET_FILE_BYTES, min_files, target.table
    )
    return dropped
