"""Session configuration, shared folders and object-store settings."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from functools import cache

from pyspark.sql import SparkSession

# Adaptive execution sizes the shuffles at run time, so no partition count is
# fixed here; a cluster sets spark.sql.shuffle.partitions as the upper bound.
# The advisory size is what a rebalanced writer gets, and so the file size;
# parallelism first would cut it down to one piece per core.
LAKE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def object_store_conf(
    endpoint: str, access_key: str = "", secret_key: str = "", path_style: bool = True
) -> dict[str, str]:
    """Settings for reading and writing ``s3a://`` paths. Never log the result."""
    conf = {
        "spark.hadoop.fs.s3a.endpoint": endpoint,
        "spark.hadoop.fs.s3a.path.style.access": str(path_style).lower(),
    }
    if access_key and secret_key:
        conf["spark.hadoop.fs.s3a.access.key"] = access_key
        conf["spark.hadoop.fs.s3a.secret.key"] = secret_key
        conf["spark.hadoop.fs.s3a.aws.credentials.provider"] = (
            "org.apache.hadoop.fs.s3a.SimpleAWSCredentialsProvider"
        )
    return conf


def catalog_conf(name: str, implementation: str, warehouse: str) -> dict[str, str]:
    """Settings that register a catalog under ``name`` with its warehouse folder."""
    prefix = f"spark.sql.catalog.{name}"
    return {prefix: implementation, f"{prefix}.warehouse": warehouse}


def build_session(
    app_name: str, master: str | None = None, conf: Mapping[str, str] | None = None
) -> SparkSession:
    """Session for a job; ``app_name`` is the job name shown by the cluster."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**LAKE_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@cache
def _local_shared(application: str) -> str:
    return tempfile.mkdtemp(prefix="lakestrata-")


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder under the cluster's shared ``spark.checkpoint.dir``.

    Only a local session, where the driver is the one machine, may do without
    that setting.
    """
    context = spark.sparkContext
    shared = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if not shared:
        if not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder shared by all executors")
        shared = _local_shared(context.applicationId)
    return f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


@contextmanager
def session_conf(spark: SparkSession, conf: Mapping[str, str]) -> Iterator[None]:
    """Set session options for the queries run inside the block, then put them back."""
    before = {key: spark.conf.get(key, None) for key in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)
