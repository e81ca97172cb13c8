"""The change log: every change row as it came."""

from __future__ import annotations

from pyspark.sql import DataFrame


def append_changes(df: DataFrame, path: str, partition: str) -> None:
    """Append change rows, kinds unchanged, to a log partitioned by ``partition``.

    The rebalance keeps the file count near the data size; adaptive execution
    splits a partition that holds much of the batch over several writers. A
    compaction of the log may run meanwhile: it replaces the files it has read
    and no others.
    """
    df.hint("rebalance", partition).write.mode("append").partitionBy(partition).parquet(path)
