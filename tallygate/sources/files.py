"""Small control files next to the datasets, on any file system Spark can reach.

Datasets are read and written by Spark.  What is left for this module is what a data
writer cannot promise: that a name is taken only once, and that a reader never sees half
a file.
"""

from __future__ import annotations

import json
import uuid
from typing import Any

from pyspark.sql import SparkSession


class AlreadyExistsError(FileExistsError):
    """The name is taken; nothing was written."""


def _path(spark: SparkSession, path: str) -> tuple[Any, Any]:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    target, system = _path(spark, path)
    return system.exists(target)


def size(spark: SparkSession, path: str) -> int:
    """Bytes below a path; the file system sums them up."""
    target, system = _path(spark, path)
    return system.getContentSummary(target).getLength()


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of what stands directly below a path."""
    target, system = _path(spark, path)
    return sorted(status.getPath().getName() for status in system.listStatus(target))


def modified(spark: SparkSession, path: str) -> dict[str, int]:
    """Names of what stands directly below a path, with the store's time of each in milliseconds."""
    target, system = _path(spark, path)
    if not system.exists(target):
        return {}
    return {s.getPath().getName(): s.getModificationTime() for s in system.listStatus(target)}


def touch(spark: SparkSession, path: str) -> None:
    """An empty file under a new name."""
    target, system = _path(spark, path)
    system.create(target, False).close()


def read_record(spark: SparkSession, path: str) -> dict[str, Any]:
    """A small JSON record, read by the driver."""
    target, system = _path(spark, path)
    stream = system.open(target)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return json.loads(text)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a directory this engine wrote; nothing happens if it is not there."""
    target, system = _path(spark, path)
    system.delete(target, True)


def write_once(spark: SparkSession, path: str, record: dict[str, Any]) -> None:
    """Write a JSON record under a new name, completely or not at all.

    The record is written beside its target and renamed without overwriting, which is
    atomic on HDFS; of two writers one gets ``AlreadyExistsError``.
    """
    target, system = _path(spark, path)
    if system.exists(target):
        raise AlreadyExistsError(path)
    draft, _ = _path(spark, f"{path.rsplit('/', 1)[0]}/.{uuid.uuid4().hex}.draft")
    stream = system.create(draft, False)
    try:
        stream.write(bytearray((json.dumps(record) + "\n").encode()))
    finally:
        stream.close()
    jvm = spark._jvm
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        target.toUri(), spark._jsc.hadoopConfiguration()
    )
    no_options = spark.sparkContext._gateway.new_array(
        jvm.org.apache.hadoop.fs.Options.Rename, 0
    )
    try:
        context.rename(
            context.makeQualified(draft), context.makeQualified(target), no_options
        )
    except Exception as failure:
        system.delete(draft, False)
        if system.exists(target):
            raise AlreadyExistsError(path) from failure
        raise
