"""Folder steps on whatever file system a path is on (Hadoop's client)."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _at(spark, path)
    return fs.exists(where)


def children(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """Names in a folder with their modification times (ms); none if absent."""
    fs, where = _at(spark, path)
    if not fs.exists(where):
        return []
    return sorted((s.getPath().getName(), s.getModificationTime()) for s in fs.listStatus(where))


def touch(spark: SparkSession, path: str) -> None:
    """An empty file, and the folders above it."""
    fs, where = _at(spark, path)
    fs.create(where, True).close()


def delete(spark: SparkSession, path: str) -> bool:
    fs, where = _at(spark, path)
    return fs.delete(where, True)
