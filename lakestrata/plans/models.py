"""Warehouse models: a function over named sources, kept as a table or a view."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestrata.functions import audit_clock
from lakestrata.sources.readers import Sources

# How the models of a layer are kept unless they say otherwise.
LAYER_DEFAULTS = {"ods": "view", "dwd": "table"}
DEFAULT = "table"


def run_model(
    spark: SparkSession,
    name: str,
    sources: Sources,
    build: Callable[[Sources], DataFrame],
    layer: str | None = None,
    materialized: str | None = None,
    keys: Sequence[str] = (),
    distributed_by: Sequence[str] = (),
    buckets: int = 4,
    location: str | None = None,
) -> DataFrame:
    """Build the model, keep it under ``name``, and return it as readers see it.

    ``keys`` are the sort key inside a bucket; they state no uniqueness, so
    nothing is dropped.
    """
    kept_as = materialized or LAYER_DEFAULTS.get(layer, DEFAULT)
    rows = build(sources)
    if kept_as == "view":
        rows.createOrReplaceTempView(name)
    elif kept_as == "table":
        save_table(rows, name, keys, distributed_by, buckets, location)
    else:
        raise ValueError(f"a model is kept as a table or a view, not as {kept_as!r}")
    return spark.table(name)


def save_table(
    rows: DataFrame,
    name: str,
    keys: Sequence[str] = (),
    distributed_by: Sequence[str] = (),
    buckets: int = 4,
    location: str | None = None,
) -> None:
    """Overwrite a table, hashed into buckets and sorted by ``keys`` within each.

    Rows are gathered by bucket first, so a writer has few buckets open; the
    rebalance lets adaptive execution cut each bucket into as many files as its
    size needs, also when one key fills most of it.
    """
    if distributed_by:
        bucket = F.pmod(F.hash(*distributed_by), F.lit(buckets))
        rows = rows.withColumn("_bucket", bucket).hint("rebalance", "_bucket").drop("_bucket")
    writer = rows.write.mode("overwrite").format("parquet")
    if location:
        writer = writer.option("path", location)
    if distributed_by:
        writer = writer.bucketBy(buckets, *distributed_by)
        if keys:
            writer = writer.sortBy(*keys)
    writer.saveAsTable(name)


def success_transactions(
    as_of: dt.datetime | None = None, tz: str = "UTC"
) -> Callable[[Sources], DataFrame]:
    """Model: the transactions that succeeded, with the time the model was built."""

    def build(source: Sources) -> DataFrame:
        raw = source("ods", "ewallet_transaction_details")
        return raw.filter(F.col("status") == "SUCCESS").select(
            "transaction_id",
            "user_id",
            "amount",
            "currency",
            "status",
            F.col("transaction_time").alias("ods_ingested_at"),
            audit_clock(as_of, tz).alias("dwd_updated_at"),
        )

    return build
