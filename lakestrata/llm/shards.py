"""Contiguous shards of equal bytes, cut by a global prefix sum."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakestrata.llm.common import stored, whole


def shard_by_bytes(docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The shard and the place in it of every document: doc_id, size, text_crc32, shard, slot.

    Documents are laid out in the order of their ids, null ids last and equal
    ids by size and checksum, and cut where the bytes before a document's
    middle pass a multiple of total / ``shards``. Each shard is a contiguous run
    and misses its target by one document at most. ``slot`` counts from 0 without
    gaps. A size is the UTF-8 bytes of the text plus 1, so null and empty texts
    have 1; repeated rows each get a place of their own. A single document
    larger than a target leaves neighbouring shards empty. An empty table gives
    no rows. Other columns are not looked at.

    Only id, size and checksum travel. Each range of ids is summed on its own;
    the totals of the ranges, one row each, are summed up in order and
    broadcast, and a running sum inside each range finishes the prefix.
    """
    sized = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(whole(text_col)) + F.lit(1)).cast("long").alias("size"),
        F.crc32(whole(text_col).cast("binary")).alias("text_crc32"),
        F.monotonically_increasing_id().alias("row"),
    )
    order = [F.col("doc_id").asc_nulls_last(), F.col("size"), F.col("text_crc32"), F.col("row")]
    ranged = stored(sized, "shard-sizes").repartitionByRange(*order)
    ranged = stored(ranged.withColumn("part", F.spark_partition_id()), "shard-ranges")

    totals = ranged.groupBy("part").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # One row per range, so no more of them than shuffle partitions.
    offsets = totals.select(
        "part",
        F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("rows_before"),
        F.sum("bytes").over(every).alias("bytes_total"),
    )
    inside = Window.partitionBy("part").orderBy(*order)
    placed = (
        ranged.withColumn("upto", F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("nth", F.row_number().over(inside).cast("long"))
        .join(F.broadcast(offsets), "part")
    )
    middle = F.expr("2 * (bytes_before + upto) - size")
    cut = (middle * shards / (F.col("bytes_total") * 2)).cast("int")
    placed = placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.least(cut, F.lit(shards - 1)).alias("shard"),
        (F.col("rows_before") + F.col("nth") - 1).alias("at"),
    )
    firsts = placed.groupBy("shard").agg(F.min("at").alias("first"))
    return placed.join(F.broadcast(firsts), "shard").select(
        "doc_id", "size", "text_crc32", "shard", (F.col("at") - F.col("first")).alias("slot")
    )
