"""Helpers the operators share."""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestrata.session import work_dir


def whole(col: str) -> Column:
    """A text column with null read as the empty text."""
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def stored(df: DataFrame, purpose: str, codec: str = "snappy") -> DataFrame:
    """The rows, written to the shared folder and read from there.

    The written table cuts the lineage, so a lost executor costs a re-read and
    not a recomputation, and its size is known to the planner.
    """
    spark = df.sparkSession
    path = work_dir(spark, purpose)
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stored_at(df: DataFrame, path: str) -> DataFrame:
    """``stored`` in a folder that is known, so that ``forget`` can delete it."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def forget(spark: SparkSession, path: str) -> None:
    """Delete a folder that ``work_dir`` gave and nothing reads any more."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def shipped(module: str) -> None:
    """Send what ``module`` defines to the workers with the task, so they need not have the package."""
    cloudpickle.register_pickle_by_value(sys.modules[module])
