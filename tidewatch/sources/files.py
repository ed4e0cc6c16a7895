"""Folder operations through the cluster's own file system (HDFS, object store or local)."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, at = _at(spark, path)
    return fs.exists(at)


def delete(spark: SparkSession, path: str) -> None:
    fs, at = _at(spark, path)
    fs.delete(at, True)


def names(spark: SparkSession, path: str) -> list[str]:
    """Sorted names in a folder; none if it does not exist."""
    fs, at = _at(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(at)) if fs.exists(at) else []


def touch(spark: SparkSession, path: str) -> None:
    fs, at = _at(spark, path)
    fs.mkdirs(at.getParent())
    fs.create(at, True).close()


def replace(spark: SparkSession, source: str, target: str) -> None:
    """Move the folder ``source`` to ``target``, which is removed first. If a crash falls
    between the two steps, ``source`` is still there and the call can be repeated."""
    fs, at = _at(spark, source)
    _, to = _at(spark, target)
    fs.mkdirs(to.getParent())
    fs.delete(to, True)
    if not fs.rename(at, to):
        raise OSError(f"could not move {source} to {target}")
