"""Upkeep of date-partitioned tables: expiry, file sizes, ordered backfill."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import replace
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestrata.operators.staging import (
    PartitionedTable,
    Replacement,
    as_text,
    claimed,
    drop_folders,
    finish_swap,
    folder_table,
    is_stream_sink,
    replace_files,
)
from lakestrata.session import session_conf
from lakestrata.sources import files as fs
from lakestrata.sources.readers import table_location

TARGET_FILE_BYTES = 128 * 1024 * 1024


def partition_date(col: str, fmt: str = "yyyyMMdd") -> Column:
    """The day a partition value stands for, NULL when it does not parse."""
    return F.to_date(F.try_to_timestamp(F.col(col).cast("string"), F.lit(fmt)))


def today(tz: str = "UTC") -> dt.date:
    """The day it is in a zone, whatever the driver's own."""
    return dt.datetime.now(ZoneInfo(tz)).date()


def _keeps(col: str, fmt: str, days: int, as_of: dt.date) -> Column:
    oldest = F.lit(as_of - dt.timedelta(days=days))
    day = partition_date(col, fmt)
    return day.isNull() | (day >= oldest)


def expire_partitions(
    df: DataFrame,
    col: str,
    fmt: str = "yyyyMMdd",
    days: int = 3650,
    as_of: dt.date | None = None,
    tz: str = "UTC",
) -> DataFrame:
    """Rows of partitions dated ``as_of - days`` or later; unparsable ones are kept.

    ``as_of`` is today in the zone ``tz`` unless given. The predicate reads the
    partition column alone, so expired folders are pruned before any file is
    opened.
    """
    return df.filter(_keeps(col, fmt, days, as_of or today(tz)))


def unparsable_partitions(df: DataFrame, col: str, fmt: str = "yyyyMMdd") -> DataFrame:
    """Partition values that expiry keeps because they are no date."""
    return df.select(col).distinct().filter(F.col(col).isNotNull() & partition_date(col, fmt).isNull())


def drop_expired_partitions(
    spark: SparkSession,
    table: str,
    col: str,
    fmt: str = "yyyyMMdd",
    days: int = 3650,
    as_of: dt.date | None = None,
    tz: str = "UTC",
) -> list[str]:
    """Drop a catalog table's expired partitions, their files too, and return their values.

    ``col`` may be one of several partition columns. Only partition names come
    to the driver; no data is read. A swap that was cut off is finished first,
    or it would bring back what is dropped.
    """
    levels = tuple(c.name for c in spark.catalog.listColumns(table) if c.isPartition)
    stored = PartitionedTable(table_location(spark, table), None, levels, table)
    keep = _keeps(col, fmt, days, as_of or today(tz))
    level = F.filter(F.split("partition", "/"), lambda part: part.startswith(f"{col}="))[0]
    value = F.substring(level, len(col) + 2, 1 << 20).alias(col)
    with claimed(spark, stored):
        finish_swap(spark, stored)
        listed = spark.sql(f"SHOW PARTITIONS {table}").select("partition", value)
        expired = sorted(listed.filter(~keep).collect())
        drop_folders(spark, stored, [row["partition"] for row in expired])
    return sorted({row[col] for row in expired})


def expire_folder(
    spark: SparkSession,
    path: str,
    col: str,
    fmt: str = "yyyyMMdd",
    days: int = 3650,
    as_of: dt.date | None = None,
    tz: str = "UTC",
) -> list[str]:
    """Delete the expired partition folders of a table without a catalog and return their values.

    ``col`` may be one of several partition levels. A swap that was cut off is
    finished first. Folders that a streaming query writes are refused: its list
    of files would name files that are gone.
    """
    _refuse_stream_sink(spark, path)
    table = folder_table(spark, path)
    keep = _keeps(col, fmt, days, as_of or today(tz))
    with claimed(spark, table):
        finish_swap(spark, table)
        if not fs.exists(spark, path):
            return []
        level = F.filter(F.split("folder", "/"), lambda part: part.startswith(f"{col}="))[0]
        value = F.substring(level, len(col) + 2, 1 << 20).alias(col)
        expired = _files(spark, path).select("folder").distinct().select("folder", value).filter(~keep).collect()
        drop_folders(spark, table, sorted(row["folder"] for row in expired))
    return sorted({row[col] for row in expired})


def _files(spark: SparkSession, path: str) -> DataFrame:
    """The data files of a folder: folder, name, bytes, bucket. Only the listing is read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true")
    plain = F.regexp_replace("path", r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "")
    inner = F.substr(plain, F.lit(len(fs.place_of(spark, path)) + 2))
    listed = files.load(path).select(inner.alias("file"), F.col("length").alias("bytes"))
    return listed.select(
        F.regexp_extract("file", "^(?:(.*)/)?[^/]*$", 1).alias("folder"),
        F.regexp_extract("file", "[^/]*$", 0).alias("name"),
        "bytes",
    ).withColumn("bucket", _stated_bucket(F.col("name")))


def _stated_bucket(name: Column) -> Column:
    """The bucket that a file's name states, or null."""
    stated = F.regexp_extract(name, r"_([0-9]{5})(?:\.[^/]*)?$", 1)
    return F.when(stated != "", stated.cast("int"))


def file_stats(spark: SparkSession, path: str, col: str) -> DataFrame:
    """Files and bytes per partition, from the file listing; no file is opened."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    return files.groupBy(col).agg(F.count("*").alias("files"), F.sum("length").alias("bytes"))


def _upkeep_conf(target_bytes: int) -> dict[str, str]:
    """Even files of the target size, and partition values as they are written: 00 stays 00."""
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_bytes),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    }


def _refuse_stream_sink(spark: SparkSession, path: str) -> None:
    if is_stream_sink(spark, path):
        raise ValueError(
            f"{path} is kept by a streaming query, whose own list of files would name files that are gone;"
            " keep the table by key and compact that"
        )


def compact_partitions(
    spark: SparkSession, src: str, dst: str, col: str, target_bytes: int = TARGET_FILE_BYTES
) -> None:
    """Rewrite the table at ``src`` to ``dst`` with files near ``target_bytes``, rows and folders unchanged.

    ``col`` is its first partition level; further ones are kept as they are. The
    rebalance gathers a partition's small files, and adaptive execution cuts a
    large partition into several writers of the advisory size.
    """
    levels = _levels(spark, src, col)
    with session_conf(spark, _upkeep_conf(target_bytes)):
        rows = spark.read.parquet(src)
        rows.hint("rebalance", *levels).write.mode("overwrite").partitionBy(*levels).parquet(dst)


def _levels(spark: SparkSession, path: str, col: str) -> tuple[str, ...]:
    """All partition levels of a folder, of which ``col`` must be the first."""
    levels = tuple(fs.partition_columns(spark, path))
    if levels[:1] != (col,):
        raise ValueError(f"{path} is partitioned by {levels}, not by {col!r}")
    return levels


def compact_in_place(
    spark: SparkSession,
    path: str,
    col: str,
    target_bytes: int = TARGET_FILE_BYTES,
    min_files: int = 3,
    table: PartitionedTable | None = None,
) -> list[str]:
    """Compact only the partitions with ``min_files`` files and at least twice those they need.

    ``col`` is the first of the table's partition levels, all of which are kept;
    buckets are compacted each by itself. Loads may append meanwhile: only the
    files that were read are replaced, and a partition of which one is gone by
    then is left for the next run and returned. Other jobs that replace files
    wait for their turn; a swap that was cut off is finished by the next of them.
    ``table`` is given for a table of the catalog. Folders that a streaming query
    writes are refused.
    """
    _refuse_stream_sink(spark, path)
    if not fs.exists(spark, path):
        return []
    target = as_text(replace(table or PartitionedTable(path, None, ()), partitions=_levels(spark, path, col)))

    def gathered() -> Replacement | None:
        needed = F.greatest(F.ceil(F.col("bytes") / target_bytes), F.lit(1))
        per_unit = _files(spark, path).groupBy("folder", "bucket").agg(
            F.count("*").alias("files"), F.sum("bytes").alias("bytes"), F.collect_list("name").alias("names")
        )
        fragmented = per_unit.filter((F.col("files") >= min_files) & (F.col("files") >= 2 * needed)).collect()
        if not fragmented:
            return None
        old = sorted(f"{row['folder']}/{name}" for row in fragmented for name in row["names"])
        rows = target.read_files(spark, old)
        if target.buckets:
            bucket = F.coalesce(_stated_bucket(F.col("_metadata.file_name")), target.bucket())
            rows = rows.withColumn("_bucket", bucket)
        return Replacement(rows, old)

    with session_conf(spark, _upkeep_conf(target_bytes)):
        return replace_files(spark, target, gathered)


def backfill(df: DataFrame, col: str, tie_cols: Sequence[str] = ()) -> DataFrame:
    """Rows in partition order, for loading history day by day.

    Ranges are cut on ``tie_cols`` too, so one hot day is spread over several
    tasks and still follows the day before it.
    """
    order = [col, *tie_cols]
    return df.repartitionByRange(*order).sortWithinPartitions(*order)
