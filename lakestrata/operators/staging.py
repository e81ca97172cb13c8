"""Replace files of a partitioned parquet table, safe to repeat after a crash.

New files are complete in a stage beside the table, and marked, before the table
is touched. The swap then moves them in and deletes the files they replace; both
can be done again, so whoever writes next finishes a swap that was cut off. Files
that came in meanwhile are not in the list of replaced ones and stay. One writer
at a time replaces files: it holds a claim on the stage, which is created by an
operation of which only one can succeed.
"""

from __future__ import annotations

import json
import re
import threading
import time
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, replace
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from lakestrata.sources import files as fs
from lakestrata.sources.readers import read_if_present

#: A claim whose holder has not renewed it for so long is that of a lost driver.
CLAIM_SECONDS = 600
#: How long a writer waits for the one before it.
CLAIM_WAIT_SECONDS = 3600
#: The claims that this process holds or waits for.
_HELD: set[str] = set()
# Fixed by Spark: how the name of a bucketed file ends, and the folder of a null.
_BUCKET_NAME = re.compile(r"_(\d{5})(?:\.[^/]*)?$")
_NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"
_BUCKET = "_bucket"
_PARTITIONS_AT_ONCE = 500


@dataclass(frozen=True)
class Replacement:
    """Rows, with all columns of the table, and the files (paths within the table) that they replace."""

    rows: DataFrame
    old: list[str]


@dataclass(frozen=True)
class PartitionedTable:
    """A parquet table by its folder, or by its name in the catalog (with its folder).

    ``partitions`` are all its partition levels. ``bucket_by`` and ``buckets`` say
    how each partition is cut further; a file then carries its bucket in its name,
    as Spark's own bucketed tables have it.
    """

    path: str
    schema: StructType | None
    partitions: tuple[str, ...]
    name: str | None = None
    bucket_by: tuple[str, ...] = ()
    buckets: int = 0

    @property
    def stage(self) -> str:
        """The one stage of the table, whoever writes to it."""
        return self.path.rstrip("/") + ".stage"

    def read(self, spark: SparkSession) -> DataFrame | None:
        """The stored rows, or None when nothing was written yet."""
        stored = spark.table(self.name) if self.name else read_if_present(spark, self.path, self.schema)
        return None if stored is None else stored.select(*self.schema.names)

    def read_files(self, spark: SparkSession, names: Iterable[str]) -> DataFrame:
        """The rows of some of its files, and of no others."""
        places = [f"{self.path.rstrip('/')}/{name}" for name in names]
        if not places:
            return spark.createDataFrame([], self.schema)
        reader = spark.read.option("basePath", self.path)
        reader = reader.schema(self.schema) if self.schema else reader.option("mergeSchema", "true")
        return reader.parquet(*places)

    def bucket(self) -> Column:
        """The bucket of a row, as Spark computes it; null in a table without buckets."""
        return F.pmod(F.hash(*self.bucket_by), F.lit(self.buckets)) if self.buckets else F.lit(None).cast("int")

    def files_of(self, spark: SparkSession, units: Iterable[tuple[str, int | None]]) -> list[str]:
        """The files of (partition folder, bucket) pairs; of the whole folder where a file has no bucket."""
        wanted: dict[str, set[int | None]] = {}
        for folder, bucket in units:
            wanted.setdefault(folder, set()).add(bucket)
        names = files_in(spark, self, wanted)
        unnamed = {_folder(name) for name in names if bucket_of(name) is None} if self.buckets else set()

        def taken(name: str) -> bool:
            folder = _folder(name)
            return not self.buckets or folder in unnamed or bucket_of(name) in wanted[folder]

        return [name for name in names if taken(name)]


def files_in(spark: SparkSession, table: PartitionedTable, folders: Iterable[str]) -> list[str]:
    """The files in partition folders, some of which may be missing."""
    places = {f"{table.path.rstrip('/')}/{folder}" for folder in folders}
    there = [place for place, found in zip(places, fs.for_all(lambda p: fs.exists(spark, p), places), strict=True) if found]
    return fs.files_below(spark, table.path, there)


def bucket_of(name: str) -> int | None:
    """The bucket that a file's name states."""
    stated = _BUCKET_NAME.search(name)
    return int(stated[1]) if stated else None


def folder_of(spark: SparkSession, partition: str, value: str | None) -> str:
    """The folder that Spark gives a partition value (as text)."""
    utils = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    return utils.getPartitionPathString(partition, value)


def partition_clause(folder: str) -> str:
    """A partition by its folder, as a clause that names it."""
    levels = []
    for level in folder.split("/"):
        name, _, value = level.partition("=")
        text = unquote(value).replace("\\", "\\\\").replace("'", "\\'")
        levels.append(f"`{unquote(name)}` = " + ("NULL" if value == _NULL_FOLDER else f"'{text}'"))
    return f"PARTITION ({', '.join(levels)})"


@contextmanager
def claimed(spark: SparkSession, table: PartitionedTable, wait: float = CLAIM_WAIT_SECONDS) -> Iterator[None]:
    """Hold the claim on a table's stage; whoever wants it too waits.

    The holder renews the claim while it works. One that was not renewed for
    ``CLAIM_SECONDS`` is taken over, and at once one that this application left
    behind, as a stream does that is stopped in the middle of a batch.
    """
    own = f"{spark.sparkContext.applicationId}:"
    place, token = f"{table.stage}/claim", f"{own}{uuid.uuid4().hex}"
    until = time.monotonic() + wait
    _HELD.add(token)
    while not fs.create_new(spark, place, token):
        holder = fs.read_text(spark, place) or ""
        left_behind = holder.startswith(own) and holder not in _HELD
        if left_behind or fs.age_seconds(spark, place) > CLAIM_SECONDS:
            fs.delete(spark, place)
        elif time.monotonic() > until:
            _HELD.discard(token)
            raise TimeoutError(f"another writer holds {table.path}")
        else:
            time.sleep(0.1)
    done = threading.Event()

    def renew() -> None:
        while not done.wait(CLAIM_SECONDS / 5):
            fs.write_text(spark, place, token)

    renewal = threading.Thread(target=renew, daemon=True)
    renewal.start()
    try:
        yield
    finally:
        done.set()
        renewal.join()
        _HELD.discard(token)
        if fs.read_text(spark, place) == token:
            fs.delete(spark, place)


def replace_files(
    spark: SparkSession, table: PartitionedTable, build: Callable[[], Replacement | None]
) -> list[str]:
    """Replace files by the rows that ``build()`` returns; None leaves the table as it is.

    Partitions of which a replaced file is gone by the time of the swap, by
    whatever other job, are left as they are, and their folders are returned.
    Readers may see old and new files of a partition together for the moment of
    its swap.
    """
    with claimed(spark, table):
        finish_swap(spark, table)
        new = build()
        if new is None:
            return []
        _stage(spark, table, new.rows)
        there = set(files_in(spark, table, {_folder(f) for f in new.old}))
        left = {_folder(f) for f in new.old if f not in there}
        for folder in left:
            fs.delete(spark, f"{table.stage}/rows/{folder}")
        _set_mark(spark, table, [f for f in new.old if _folder(f) not in left])
        finish_swap(spark, table)
        return sorted(left)


def finish_pending(spark: SparkSession, table: PartitionedTable) -> None:
    """Finish a swap that a lost driver left, if there is one."""
    if fs.exists(spark, f"{table.stage}/mark"):
        with claimed(spark, table):
            finish_swap(spark, table)


def _stage(spark: SparkSession, table: PartitionedTable, rows: DataFrame) -> None:
    place = f"{table.stage}/rows"
    fs.delete(spark, place)
    keys = list(table.partitions)
    if table.buckets and _BUCKET not in rows.columns:
        rows = rows.withColumn(_BUCKET, table.bucket())
    if _BUCKET in rows.columns:
        keys.append(_BUCKET)
    gathered = rows.hint("rebalance", *keys)
    if table.bucket_by:
        # The writer sorts by partition and bucket anyhow; the table declares that buckets are sorted.
        gathered = gathered.sortWithinPartitions(*keys, *table.bucket_by)
    writer = gathered.write.partitionBy(*keys) if keys else gathered.write
    writer.parquet(place)


def _set_mark(spark: SparkSession, table: PartitionedTable, old: list[str]) -> None:
    """Mark the stage as complete, naming the files to replace."""
    fs.write_text(spark, f"{table.stage}/mark", json.dumps({"old": old}))


def _folder(name: str) -> str:
    return name.rpartition("/")[0]


def _target(name: str) -> str:
    """Where in the table a staged file goes: its bucket moves from its folder into its name."""
    folder, _, file = name.rpartition("/")
    above, _, last = folder.rpartition("/")
    if last.startswith(f"{_BUCKET}="):
        folder, bucket = above, last.partition("=")[2]
        if bucket != _NULL_FOLDER:
            stem, dot, kind = file.partition(".")
            file = f"{stem}_{int(bucket):05d}{dot}{kind}"
    return f"{folder}/{file}" if folder else file


def finish_swap(spark: SparkSession, table: PartitionedTable) -> None:
    """Bring in what is staged and marked. The caller holds the claim."""
    mark = fs.read_text(spark, f"{table.stage}/mark")
    if mark is None:
        return
    old = json.loads(mark)["old"]
    staged = fs.data_files(spark, f"{table.stage}/rows")
    _move_in(spark, table, staged)
    _delete_old(spark, table, old)
    _tell_catalog(spark, table, {_folder(_target(name)) for name in staged}, {_folder(name) for name in old})
    fs.delete(spark, f"{table.stage}/mark")
    fs.delete(spark, f"{table.stage}/rows")


def _move_in(spark: SparkSession, table: PartitionedTable, staged: list[str]) -> None:
    fs.for_all(lambda n: fs.move(spark, f"{table.stage}/rows/{n}", f"{table.path}/{_target(n)}"), staged)


def _delete_old(spark: SparkSession, table: PartitionedTable, old: list[str]) -> None:
    fs.for_all(lambda name: fs.delete(spark, f"{table.path}/{name}"), old)


def _tell_catalog(spark: SparkSession, table: PartitionedTable, came: set[str], went: set[str]) -> None:
    """Drop the partitions that have no file left, and name new ones to the catalog."""
    lost = {f for f in went - came if f}
    drop_folders(spark, table, sorted(lost - {_folder(name) for name in files_in(spark, table, lost)}))
    if not table.name:
        return
    new = sorted(f for f in came if f)
    for at in range(0, len(new), _PARTITIONS_AT_ONCE):
        clauses = " ".join(partition_clause(f) for f in new[at : at + _PARTITIONS_AT_ONCE])
        spark.sql(f"ALTER TABLE {table.name} ADD IF NOT EXISTS {clauses}")
    spark.catalog.refreshTable(table.name)


def drop_folders(spark: SparkSession, table: PartitionedTable, folders: list[str]) -> None:
    """Drop partitions by their folders, from the catalog and from the store.

    A table with a location of its own is external: dropping its partitions
    leaves their files, so these are deleted as well.
    """
    if table.name:
        for at in range(0, len(folders), _PARTITIONS_AT_ONCE):
            clauses = ", ".join(partition_clause(f) for f in folders[at : at + _PARTITIONS_AT_ONCE])
            spark.sql(f"ALTER TABLE {table.name} DROP IF EXISTS {clauses}")
    fs.for_all(lambda folder: fs.delete(spark, f"{table.path}/{folder}"), folders)
    if table.name and folders:
        spark.catalog.refreshTable(table.name)


def folder_table(spark: SparkSession, path: str, schema: StructType | None = None) -> PartitionedTable:
    """A folder as a table, its partition levels read off its first branch."""
    levels = fs.partition_columns(spark, path) if fs.exists(spark, path) else []
    return PartitionedTable(path, schema, tuple(levels))


def as_text(table: PartitionedTable) -> PartitionedTable:
    """The table with its partition values as they are written: 00 stays 00."""
    if table.schema is None:
        return table
    fields = [StructField(f.name, StringType()) if f.name in table.partitions else f for f in table.schema]
    return replace(table, schema=StructType(fields))


def is_stream_sink(spark: SparkSession, path: str) -> bool:
    """Whether a streaming query keeps its own list of files in the folder."""
    return fs.exists(spark, f"{path.rstrip('/')}/_spark_metadata")
