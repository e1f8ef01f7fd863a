"""Shared scratch area for staged tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_local_root: str | None = None
_passing: ContextVar[tuple[list[str], ...]] = ContextVar("passing", default=())


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder the session names.

    Only a local master may fall back to a temporary folder of the machine.
    """
    root = spark.conf.get(_SETTING, None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"{_SETTING} must name a shared folder on a cluster")
        global _local_root
        _local_root = _local_root or tempfile.mkdtemp(prefix="touchline-")
        root = _local_root
    return f"{root.rstrip('/')}/touchline/{label}-{uuid.uuid4().hex}"


@contextmanager
def passing(spark: SparkSession) -> Iterator[None]:
    """What is staged inside the block is removed when the block ends, except what is staged with ``keep``.

    For steps that end in a stored table of their own, which reads none of the
    others. Tables staged before, or by other threads, are not touched.
    """
    paths: list[str] = []
    token = _passing.set((*_passing.get(), paths))
    try:
        yield
    finally:
        _passing.reset(token)
        for path in paths:
            remove(spark, path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that the caller wrote and nobody reads any more; a missing one is no error."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def shuffles_go(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of every query that runs inside the block go when that query ends, as nothing reads them again."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def staged(df: DataFrame, label: str, keep: bool = False) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage and survives lost executors, because the files outlive
    the tasks that wrote them. The shuffle files of the write go when it ends,
    since nothing reads them again. Files are compressed by zstandard, as they
    stay. With ``keep`` the table outlives the innermost ``passing`` block.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    open_blocks = _passing.get()[:-1] if keep else _passing.get()
    if open_blocks:
        open_blocks[-1].append(path)
    with shuffles_go(spark):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
