"""Batch and stream scans."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: How far behind the newest file a stream still takes a file, by its time stamp.
#: Files that were copied with their times, or replicated late, are older than they arrive.
MAX_FILE_AGE = "36500d"
#: What a stream takes at a time, the first batch included.
MAX_BATCH_BYTES = 16 * 1024 * 1024 * 1024


@dataclass(frozen=True)
class Sources:
    """Named source relations: (group, table) to a parquet path or a catalog table."""

    spark: SparkSession
    relations: Mapping[tuple[str, str], str | DataFrame]

    def __call__(self, group: str, table: str) -> DataFrame:
        relation = self.relations[(group, table)]
        if isinstance(relation, DataFrame):
            return relation
        if "/" in relation:
            return self.spark.read.parquet(relation)
        return self.spark.table(relation)


def scan(
    spark: SparkSession,
    path: str,
    schema: StructType | None = None,
    streaming: bool = False,
    max_bytes_per_batch: int | None = MAX_BATCH_BYTES,
    max_files_per_batch: int | None = None,
    max_file_age: str = MAX_FILE_AGE,
) -> DataFrame:
    """Read a parquet table, as a bounded scan or as a stream of its present and later files.

    A stream keeps its position in the checkpoint of the query that reads it.
    It takes at most ``max_bytes_per_batch`` at a time (a larger file by itself),
    or ``max_files_per_batch`` files instead, and every file whose time stamp is
    no more than ``max_file_age`` behind the newest one.
    """
    if not streaming:
        reader = spark.read
        return (reader.schema(schema) if schema else reader).parquet(path)
    if schema is None:
        raise ValueError("a streaming scan needs a schema")
    stream = spark.readStream.schema(schema).option("maxFileAge", max_file_age)
    if max_files_per_batch:
        stream = stream.option("maxFilesPerTrigger", max_files_per_batch)
    elif max_bytes_per_batch:
        stream = stream.option("maxBytesPerTrigger", max_bytes_per_batch)
    return stream.parquet(path)


def read_if_present(
    spark: SparkSession, path: str, schema: StructType, base_path: str | None = None
) -> DataFrame | None:
    """The table at ``path`` (a folder or a glob), or None when nothing is there yet."""
    try:
        return spark.read.schema(schema).option("basePath", base_path or path).parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def partition_values(partitions: DataFrame) -> list[str | None]:
    """The distinct values of the one column of ``partitions``, as Spark writes them in a folder's name.

    One value per partition comes to the driver.
    """
    column = F.col(f"`{partitions.columns[0]}`").cast("string").alias("value")
    return [row["value"] for row in partitions.select(column).distinct().collect()]


def partition_filter(partition: str, values: Sequence[str | None]) -> Column:
    """A predicate on the partition column alone, so the scan lists no other partition's files."""
    as_text = F.col(f"`{partition}`").cast("string")
    named = [value for value in values if value is not None]
    wanted = as_text.isin(named) if named else F.lit(False)
    return wanted | as_text.isNull() if None in values else wanted


def _file_system(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def set_modified(spark: SparkSession, path: str, pattern: str, days_ago: int) -> None:
    """Give the files that match ``pattern`` in a folder an older time stamp, as a copy that keeps times does."""
    system, where = _file_system(spark, f"{path}/{pattern}")
    for status in system.globStatus(where):
        system.setTimes(status.getPath(), status.getModificationTime() - days_ago * 86_400_000, -1)


def table_options(spark: SparkSession, name: str) -> dict[str, str]:
    """The options a catalog table was created with."""
    return {row["key"]: row["value"] for row in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}


def table_location(spark: SparkSession, name: str) -> str:
    """The folder of a catalog table."""
    described = spark.sql(f"DESCRIBE EXTENDED {name}").filter("col_name = 'Location'")
    return described.first()["data_type"]
