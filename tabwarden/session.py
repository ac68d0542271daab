"""A session with the settings the library expects; on a cluster the submitter's own settings win."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache

from pyspark.sql import DataFrame, SparkSession


def session(name: str = "tabwarden", **conf: str) -> SparkSession:
    wanted = {"spark.sql.session.timeZone": "UTC", "spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "true", **conf}
    builder = SparkSession.builder.appName(name)
    for k, v in wanted.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, ``spark.checkpoint.dir``.

    Where it is unset, a local session gets a folder of this process, and any other is refused: its executors would not see one.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    return (found or _own_dir()).rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name in the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder or file of any store that Spark writes to."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def rename(spark: SparkSession, old: str, new: str) -> None:
    """Rename a folder of any store that Spark writes to."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    if not path(old).getFileSystem(spark._jsc.hadoopConfiguration()).rename(path(old), path(new)):
        raise OSError(f"{old} could not be renamed")


#: Tables of :func:`written` that are still there.
_TABLES: set[str] = set()


#: Spark's switch for deleting an execution's shuffles at its end.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_deleted(spark: SparkSession) -> Iterator[None]:
    """What is executed here deletes its shuffles at its end, not when the driver happens to collect garbage."""
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


def written(df: DataFrame, name: str, row_group: int | None = None) -> DataFrame:
    """``df`` as a table in the shared folder: all readings agree, and lost executors cost only the reading.

    Files can be split between row groups, whose bytes ``row_group`` bounds.
    """
    spark, path = df.sparkSession, scratch(df.sparkSession, name)
    to = df.write.option("compression", "zstd")
    (to.option("parquet.block.size", row_group) if row_group else to).parquet(path)
    _TABLES.add(path)
    return spark.read.schema(df.schema).parquet(path)


def in_splits(table: DataFrame, size: int) -> DataFrame:
    """A table of :func:`written` in splits of ``size`` bytes at most, by a session of its own: no row moves."""
    spark = table.sparkSession
    own = spark.newSession()
    for k, v in spark.conf.getAll.items():
        if spark.conf.isModifiable(k):
            own.conf.set(k, v)
    own.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    return own.read.schema(table.schema).parquet(*{os.path.dirname(f) for f in table.inputFiles()})


def discard(spark: SparkSession, table: DataFrame) -> None:
    """Delete a table of :func:`written`."""
    for path in {os.path.dirname(f) for f in table.inputFiles()}:
        delete(spark, path)
        _TABLES.difference_update([t for t in _TABLES if os.path.basename(t) == os.path.basename(path)])


def discard_written(spark: SparkSession) -> None:
    """Delete the tables of :func:`written`; results that were not saved elsewhere go with them."""
    for path in list(_TABLES):
        delete(spark, path)
    _TABLES.clear()


@cache
def _own_dir() -> str:
    return f"file://{tempfile.mkdtemp(prefix='tabwarden-')}"
