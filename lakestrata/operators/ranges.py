"""Load history in ranges of partitions, and go on after a stop."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestrata.operators.maintain import backfill, file_stats
from lakestrata.session import session_conf
from lakestrata.sources import files as fs
from lakestrata.sources.readers import partition_filter

#: Bytes that one range has at most, unless a single partition has more.
RANGE_BYTES = 64 * 1024 * 1024 * 1024


def cut_ranges(sizes: Sequence[tuple[str | None, int]], range_bytes: int) -> list[list[str | None]]:
    """Partition values in order, cut into runs of at most ``range_bytes``; a larger partition is a run by itself."""
    runs: list[list[str | None]] = []
    filled = 0
    for value, size in sizes:
        if not runs or filled + size > range_bytes:
            runs.append([])
            filled = 0
        runs[-1].append(value)
        filled += size
    return runs


def run_backfill(
    spark: SparkSession,
    src: str,
    col: str,
    book: str,
    write: Callable[[DataFrame, int], None],
    tie_cols: Sequence[str] = (),
    range_bytes: int = RANGE_BYTES,
    most: int | None = None,
) -> tuple[int, int]:
    """Hand the partitions of ``src`` to ``write``, range after range in the order of ``col``.

    The ranges are cut by the bytes of their files at the first start and kept in
    the folder ``book``, so that a restart meets the same ones; each finished
    range is noted there and not taken again. A range that was cut off is handed
    out once more with the same number, which ``write`` must be able to repeat.
    ``most`` stops after so many ranges. Returns how many are finished, and how
    many there are. Numbers are ordered as numbers, other values as text, null
    first.
    """
    plan = fs.read_text(spark, f"{book}/plan")
    if plan is None:
        with session_conf(spark, {"spark.sql.sources.partitionColumnTypeInference.enabled": "false"}):
            order = [F.col(col).isNotNull(), F.col(col).try_cast("decimal(38,0)"), F.col(col)]
            rows = file_stats(spark, src, col).orderBy(*order).collect()
        plan = json.dumps(cut_ranges([(row[col], row["bytes"]) for row in rows], range_bytes))
        fs.write_text(spark, f"{book}/plan", plan)
    ranges = json.loads(plan)
    finished = set(fs.data_files(spark, f"{book}/done"))
    taken = 0
    for number, values in enumerate(ranges):
        if f"{number:06d}" in finished:
            continue
        if most is not None and taken == most:
            break
        stored = spark.read.parquet(src).filter(partition_filter(col, values))
        write(backfill(stored, col, tie_cols), number)
        fs.write_text(spark, f"{book}/done/{number:06d}", json.dumps(values))
        finished.add(f"{number:06d}")
        taken += 1
    return len(finished), len(ranges)


def finished_ranges(spark: SparkSession, book: str) -> DataFrame:
    """The finished ranges: number, first, last, partitions."""
    rows = []
    for name in fs.data_files(spark, f"{book}/done"):
        values = json.loads(fs.read_text(spark, f"{book}/done/{name}"))
        rows.append((int(name), values[0], values[-1], len(values)))
    return spark.createDataFrame(rows, "number int, first string, last string, partitions int")
