"""Files and folders through the file system that Spark itself uses, whatever the store."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import cache
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

#: File operations that the driver has under way at a time.
_AT_ONCE = 16


def _system(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    system, where = _system(spark, path)
    return system.exists(where)


def delete(spark: SparkSession, path: str) -> None:
    """Delete a file or a folder, if it is there."""
    system, where = _system(spark, path)
    system.delete(where, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Move a file into a folder that is made if need be; done already when only the target is there."""
    system, where = _system(spark, source)
    to = spark._jvm.org.apache.hadoop.fs.Path(target)
    system.mkdirs(to.getParent())
    if not system.rename(where, to) and (system.exists(where) or not system.exists(to)):
        raise OSError(f"{source} could not be moved to {target}")


def data_files(spark: SparkSession, path: str) -> list[str]:
    """The data files below a folder, by their paths within it; none when it is missing."""
    return files_below(spark, path, [path]) if exists(spark, path) else []


def files_below(spark: SparkSession, top: str, folders: Sequence[str]) -> list[str]:
    """The data files below some folders that are there, by their paths within ``top``.

    Spark lists them, by a job where there are many, and leaves out what is hidden.
    """
    if not folders:
        return []
    found = spark.read.schema("x int").option("recursiveFileLookup", "true").parquet(*folders)
    start = len(place_of(spark, top)) + 1
    return sorted(_place(name)[start:] for name in found.inputFiles())


def place_of(spark: SparkSession, path: str) -> str:
    """A path without its scheme and authority."""
    return spark._jvm.org.apache.hadoop.fs.Path(path).toUri().getPath().rstrip("/")


def within(spark: SparkSession, path: str, uri: str) -> str:
    """The path inside the folder ``path`` of a file that Spark names by ``uri``."""
    return _place(uri)[len(place_of(spark, path)) + 1 :]


def _place(uri: str) -> str:
    return unquote(re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "", uri))


def partition_columns(spark: SparkSession, path: str) -> list[str]:
    """The names of the partition levels of a folder, read off its first branch."""
    system, where = _system(spark, path)
    names: list[str] = []
    while True:
        folders = [s.getPath() for s in system.listStatus(where) if s.isDirectory() and "=" in s.getPath().getName()]
        if not folders:
            return names
        where = min(folders, key=lambda folder: folder.getName())
        names.append(unquote(where.getName().partition("=")[0]))


def for_all(work, items: Iterable) -> list:
    """Do the same small file operation for each item, some at a time, and return what each gave."""
    return list(_pool().map(work, items))


@cache
def _pool() -> ThreadPoolExecutor:
    # Kept: every new thread would open a connection to the JVM, and close it.
    return ThreadPoolExecutor(_AT_ONCE, thread_name_prefix="files")


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file; it is there whole or not at all."""
    system, where = _system(spark, path)
    half = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.half")
    out = system.create(half, True)
    out.write(bytearray(text.encode()))
    out.close()
    system.delete(where, False)
    if not system.rename(half, where):
        raise OSError(f"{path} could not be written")


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file's text, or None when it is not there."""
    system, where = _system(spark, path)
    if not system.exists(where):
        return None
    stream = system.open(where)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def create_new(spark: SparkSession, path: str, text: str) -> bool:
    """Create a file that must not exist; of several that try at once one succeeds.

    The file system decides. The local one checks before it creates, so there
    Java's own exclusive creation is used; a store without exclusive creation
    gives no such promise.
    """
    system, where = _system(spark, path)
    try:
        if system.getUri().getScheme() == "file":
            system.mkdirs(where.getParent())
            if not spark._jvm.java.io.File(where.toUri().getPath()).createNewFile():
                return False
            out = system.create(where, True)
        else:
            out = system.create(where, False)
    except Py4JJavaError as error:
        if "AlreadyExists" in error.java_exception.getClass().getName():
            return False
        raise
    out.write(bytearray(text.encode()))
    out.close()
    return True


def age_seconds(spark: SparkSession, path: str) -> float:
    """Seconds since a file was written, by the clock of this driver; 0 when it is gone."""
    system, where = _system(spark, path)
    try:
        written = system.getFileStatus(where).getModificationTime()
    except Py4JJavaError:
        return 0.0
    return spark._jvm.System.currentTimeMillis() / 1000 - written / 1000
