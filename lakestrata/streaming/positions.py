"""Where the named readers of a source are, which of them are gone, and what all of them have read."""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Iterator
from contextlib import contextmanager
from itertools import islice

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from lakestrata.sources import files as fs

_SCHEMA = "reader string, checkpoint string, batch long, seen_at timestamp"
_DELETED_AT_ONCE = 1000


class _Positions(StreamingQueryListener):
    """Writes a small file for each named reader whenever it finished a batch, and when it is idle."""

    def __init__(self, spark: SparkSession, place: str, checkpoints: dict[str, str]) -> None:
        self.spark, self.place, self.checkpoints = spark, place, checkpoints

    def _note(self, name: str | None, batch: int | None, at: str) -> None:
        if name not in self.checkpoints:
            return
        path = f"{self.place}/{name}.json"
        if batch is None:
            batch = json.loads(fs.read_text(self.spark, path) or "{}").get("batch", -1)
        row = {"reader": name, "checkpoint": self.checkpoints[name], "batch": batch, "seen_at": at}
        fs.write_text(self.spark, path, json.dumps(row))

    def onQueryStarted(self, event) -> None:
        self._note(event.name, None, event.timestamp)

    def onQueryProgress(self, event) -> None:
        self._note(event.progress.name, event.progress.batchId, event.progress.timestamp)

    def onQueryIdle(self, event) -> None:
        """An idle reader has no name here; its last progress stands."""

    def onQueryTerminated(self, event) -> None:
        """A reader that ended keeps its position until it expires."""


@contextmanager
def positions_kept(spark: SparkSession, place: str, checkpoints: dict[str, str]) -> Iterator[None]:
    """Keep the positions of the named readers (name to checkpoint) at ``place`` while the block runs."""
    listener = _Positions(spark, place, checkpoints)
    spark.streams.addListener(listener)
    try:
        yield
    finally:
        # Events come behind the queries they tell of.
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        spark.streams.removeListener(listener)


def reader_positions(spark: SparkSession, place: str) -> DataFrame:
    """One row per reader: reader, checkpoint, the last batch, and when it was seen last."""
    if not fs.exists(spark, place) or not fs.data_files(spark, place):
        return spark.createDataFrame([], _SCHEMA)
    return spark.read.schema(_SCHEMA).option("pathGlobFilter", "*.json").json(place)


def expire_readers(spark: SparkSession, place: str, idle: dt.timedelta, as_of: dt.datetime | None = None) -> list[str]:
    """Forget the readers that were not seen for ``idle``, and return their names.

    One that comes back reads on from its checkpoint, as far as its files are
    still there. One row per reader comes to the driver.
    """
    now = F.lit(as_of) if as_of else F.current_timestamp()
    late = reader_positions(spark, place).filter(F.col("seen_at") < now - F.lit(idle)).select("reader").collect()
    names = sorted(row["reader"] for row in late)
    for name in names:
        fs.delete(spark, f"{place}/{name}.json")
    return names


def read_files(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The source files of the batches that a reader committed: one column, file.

    The file source notes in its checkpoint which files it put into which batch;
    only those of committed batches count.
    """
    noted = f"{checkpoint}/sources/0"
    done = [name for name in fs.data_files(spark, f"{checkpoint}/commits") if name.split(".")[0].isdigit()]
    if not done or not fs.data_files(spark, noted):
        return spark.createDataFrame([], "file string")
    last = max(int(name.split(".")[0]) for name in done)
    lines = spark.read.option("pathGlobFilter", "[0-9]*").text(noted).filter(F.col("value").startswith("{"))
    entry = F.from_json("value", "path string, batchId long")
    return lines.select(entry.alias("e")).filter(F.col("e.batchId") <= last).select(F.col("e.path").alias("file")).distinct()


def clean_source(spark: SparkSession, place: str) -> int:
    """Delete the source files that every reader that has not expired has read; return how many.

    The slowest of them holds the rest back. Without a reader nothing is deleted.
    """
    readers = reader_positions(spark, place).select("checkpoint").collect()
    if not readers:
        return 0
    counted = None
    for row in readers:
        files = read_files(spark, row["checkpoint"])
        counted = files if counted is None else counted.unionAll(files)
    common = counted.groupBy("file").agg(F.count("*").alias("readers")).filter(F.col("readers") == len(readers))
    names, deleted = common.select("file").toLocalIterator(), 0
    while some := [row["file"] for row in islice(names, _DELETED_AT_ONCE)]:
        deleted += sum(fs.for_all(lambda name: _gone(spark, name), some))
    return deleted


def _gone(spark: SparkSession, name: str) -> bool:
    place = spark._jvm.org.apache.spark.paths.SparkPath.fromUrlString(name).toPath().toString()
    if not fs.exists(spark, place):
        return False
    fs.delete(spark, place)
    return True
