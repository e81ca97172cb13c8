"""Upsert a batch of changes into a partitioned parquet table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakestrata.operators.staging import PartitionedTable, Replacement, folder_of, replace_files
from lakestrata.operators.versions import (
    DELETE,
    ROW_KIND,
    lookup_width,
    merge_few_winners,
    merge_winners,
    winning_changes,
)
from lakestrata.sources.files import within


@dataclass(frozen=True)
class UpsertTarget:
    """A keyed table stored with sequence and row kind, deletes included.

    It is a folder, or, with ``name``, a table of the catalog in that folder. The
    partition column is part of the key, and so are the columns that the
    ``buckets`` of a partition are hashed by: a change never moves a row between
    partitions or buckets, which is what makes the rewrite of touched buckets
    (without buckets: partitions) exact. Batches whose keys and sequences take at
    most ``broadcast_bytes`` are merged without shuffling the table.
    """

    path: str
    schema: StructType
    keys: tuple[str, ...]
    seq: tuple[str, ...]
    partition: str
    kind: str = ROW_KIND
    keep_first: tuple[str, ...] = ()
    broadcast_bytes: int = 64 * 1024 * 1024
    name: str | None = None
    bucket_by: tuple[str, ...] = ()
    buckets: int = 0
    file_bytes: int | None = None

    def __post_init__(self) -> None:
        if self.partition not in self.keys:
            raise ValueError("the partition column must be one of the keys")
        if not set(self.bucket_by) <= set(self.keys) - {self.partition}:
            raise ValueError("the columns of the buckets must be keys, and not the partition")

    @property
    def table(self) -> PartitionedTable:
        return PartitionedTable(self.path, self.schema, (self.partition,), self.name, self.bucket_by, self.buckets)

    def read(self, spark: SparkSession) -> DataFrame:
        """The stored rows, deletes included; empty when nothing was written yet."""
        stored = self.table.read(spark)
        return spark.createDataFrame([], self.schema) if stored is None else stored


def upsert(spark: SparkSession, target: UpsertTarget, changes: DataFrame) -> None:
    """Merge ``changes`` into the table.

    Only the files of the buckets that hold a changed key are read and written.
    A batch that is run again changes nothing: a change with a sequence that the
    table already has is not applied. A swap that a lost driver left half done,
    by whichever job, is finished first.
    """
    table = target.table

    def merged() -> Replacement | None:
        rows = changes.select(*target.schema.names)
        # Written out, the winners have a known size for the join, and losing an
        # executor never recomputes the change batch.
        place = f"{table.stage}/winners"
        winning_changes(rows, target.keys, target.seq, target.kind).write.mode("overwrite").parquet(place)
        winners = spark.read.schema(target.schema).parquet(place)
        touched = (
            winners.groupBy(F.col(f"`{target.partition}`").cast("string").alias("value"), table.bucket().alias("bucket"))
            .agg(F.sum(lookup_width(target.keys, target.seq)).alias("bytes"))
            .collect()
        )
        if not touched:
            return None
        units = [(folder_of(spark, target.partition, row["value"]), row["bucket"]) for row in touched]
        old = table.files_of(spark, units)
        if not old:
            return Replacement(winners, [])
        few = sum(row["bytes"] for row in touched) <= target.broadcast_bytes
        merge = merge_few_winners if few else merge_winners
        base = table.read_files(spark, old).select(*target.schema.names)
        return Replacement(merge(base, winners, target.keys, target.seq, target.kind, target.keep_first), old)

    replace_files(spark, table, merged)


def purge_deletes(spark: SparkSession, target: UpsertTarget, settled: Column) -> None:
    """Drop the ``-D`` rows for which ``settled`` holds: no older change can still arrive for them.

    Only files that hold such rows are rewritten, and partitions that hold
    nothing else are dropped.
    """
    table = target.table
    gone = F.col(target.kind).eqNullSafe(DELETE) & F.coalesce(settled, F.lit(False))

    def remaining() -> Replacement | None:
        stored = table.read(spark)
        if stored is None:
            return None
        holding = stored.filter(gone).select("_metadata.file_path").distinct().collect()
        old = sorted(within(spark, target.path, row["file_path"]) for row in holding)
        if not old:
            return None
        return Replacement(table.read_files(spark, old).select(*target.schema.names).filter(~gone), old)

    replace_files(spark, table, remaining)


def merge_into(
    table: str,
    changes: DataFrame,
    keys: Sequence[str],
    seq: str | Sequence[str],
    kind: str = ROW_KIND,
) -> None:
    """The same merge for a catalog table whose format takes MERGE, which needs no staging.

    The table holds the sequence and row kind columns too. File tables refuse
    MERGE; they go through ``upsert``.
    """
    order = [seq] if isinstance(seq, str) else list(seq)
    winners = winning_changes(changes, keys, order, kind).alias("changes")
    same = " AND ".join(f"{table}.`{k}` <=> changes.`{k}`" for k in keys)
    stored, incoming = (
        f"struct({', '.join(f'{side}.`{c}`' for c in order)})" for side in (table, "changes")
    )
    (
        winners.mergeInto(table, F.expr(same))
        .whenMatched(F.expr(f"{incoming} > {stored}"))
        .updateAll()
        .whenNotMatched()
        .insertAll()
        .merge()
    )
