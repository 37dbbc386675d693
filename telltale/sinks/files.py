"""Folders of whatever file system a path is on, through Spark's Hadoop client."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _opened(spark: SparkSession, path: str):
    context = spark.sparkContext
    named = context._jvm.org.apache.hadoop.fs.Path(path)
    return named.getFileSystem(context._jsc.hadoopConfiguration()), named


def exists(spark: SparkSession, path: str) -> bool:
    system, named = _opened(spark, path)
    return system.exists(named)


def subfolders(spark: SparkSession, path: str) -> dict[str, float]:
    """Names of the folders right below a path, with the time of their last change in seconds."""
    system, named = _opened(spark, path)
    if not system.exists(named):
        return {}
    found = (s for s in system.listStatus(named) if s.isDirectory())
    return {s.getPath().getName(): s.getModificationTime() / 1000 for s in found}


def delete(spark: SparkSession, path: str) -> None:
    system, named = _opened(spark, path)
    system.delete(named, True)


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small text file; None if it is not there."""
    system, named = _opened(spark, path)
    if not system.exists(named):
        return None
    stream = system.open(named)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Put a small text file in place as a whole; readers of the folder pass over its half."""
    folder, _, name = path.rpartition("/")
    system, named = _opened(spark, f"{folder}/_{name}-{uuid.uuid4().hex}")
    stream = system.create(named)
    stream.write(bytearray(text.encode()))
    stream.close()
    final = _opened(spark, path)[1]
    if not system.rename(named, final):
        system.delete(named, False)
