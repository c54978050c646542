"""File-system calls on table folders."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _located(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    location = jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), location


def exists(spark: SparkSession, path: str) -> bool:
    files, location = _located(spark, path)
    return files.exists(location)


def remove(spark: SparkSession, path: str) -> None:
    files, location = _located(spark, path)
    files.delete(location, True)


def make_folder(spark: SparkSession, path: str) -> None:
    files, location = _located(spark, path)
    files.mkdirs(location)


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its scheme, as Spark names files."""
    files, location = _located(spark, path)
    return files.makeQualified(location).toString()


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that fit a pattern, sorted; none if its folder is not there."""
    files, location = _located(spark, pattern)
    return sorted(found.getPath().toString() for found in files.globStatus(location) or [])
