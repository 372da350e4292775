"""Small operations on folders of any file system that Spark can reach."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _at(spark, path)
    return bool(fs.exists(where))


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of what a folder holds; none if it is not there."""
    fs, where = _at(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(where)) if fs.exists(where) else []


def remove(spark: SparkSession, path: str) -> bool:
    fs, where = _at(spark, path)
    return bool(fs.delete(where, True))


def move(spark: SparkSession, source: str, target: str) -> bool:
    """Rename a folder in one step; a missing one stays missing. Says whether it was there."""
    fs, old = _at(spark, source)
    if not fs.exists(old):
        return False
    new = _at(spark, target)[1]
    fs.mkdirs(new.getParent())
    return bool(fs.rename(old, new))


def whole(spark: SparkSession, path: str) -> bool:
    """Was the write of this folder finished?"""
    return exists(spark, f"{path}/_SUCCESS")


def committed_batch(spark: SparkSession, checkpoint: str) -> int:
    """Number of the last batch that a streaming query has finished; -1 before the first."""
    return max((int(n) for n in names(spark, f"{checkpoint}/commits") if n.isdigit()), default=-1)
