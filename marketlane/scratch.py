"""Intermediate tables in the shared folder named by ``spark.checkpoint.dir``.

A frame that several later jobs read is written once as Parquet and read back,
so its lineage ends at files that survive the loss of any executor.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_local_root: str | None = None
_given: list[str] = []


def root(spark: SparkSession) -> str:
    """The shared scratch folder; a temporary one only for a local master."""
    global _local_root
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="marketlane-")
        atexit.register(shutil.rmtree, _local_root, ignore_errors=True)
    return _local_root


def new_dir(spark: SparkSession, label: str) -> str:
    """A path nobody has used yet; the caller writes to it."""
    path = f"{root(spark)}/{label}-{uuid.uuid4().hex}"
    _given.append(path)
    return path


def durable(df: DataFrame, label: str, options: dict[str, str] | None = None) -> DataFrame:
    """Write ``df`` once, with the writer's ``options``, and return a scan of what was written."""
    spark = df.sparkSession
    path = new_dir(spark, label)
    df.write.options(**(options or {})).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _delete(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def finished(spark: SparkSession, path: str) -> list[str]:
    """The folders right under ``path`` that a job has written to its end."""
    parent = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = parent.getFileSystem(spark._jsc.hadoopConfiguration())
    found = [entry.getPath() for entry in files.listStatus(parent) if entry.isDirectory()]
    mark = spark._jvm.org.apache.hadoop.fs.Path
    return sorted(p.toString() for p in found if files.exists(mark(p, "_SUCCESS")))


def delete(spark: SparkSession, paths: list[str]) -> None:
    for path in paths:
        _delete(spark, path)


@contextmanager
def held(df: DataFrame, label: str) -> Iterator[DataFrame]:
    """``durable`` for the length of a block; what was written is deleted after it."""
    spark = df.sparkSession
    path = new_dir(spark, label)
    try:
        df.write.parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        _delete(spark, path)
        _given.remove(path)


def clear(spark: SparkSession) -> int:
    """Delete what this process put in the scratch folder; returns the number of paths deleted.

    Call it when no frame built on these tables is needed any more.
    """
    deleted = 0
    for path in _given:
        deleted += bool(_delete(spark, path))
    _given.clear()
    return deleted
