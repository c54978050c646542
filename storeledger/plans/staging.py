"""Staged tables."""

from __future__ import annotations

import contextlib
import contextvars
import itertools
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storeledger.plans import storage
from storeledger.session import new_work_path

# File names that one scan is given; the driver holds no more at a time.
FILES_PER_SCAN = 500

_SCRATCH: contextvars.ContextVar[list[str] | None] = contextvars.ContextVar("scratch", default=None)


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Remove what is staged inside the block when it ends."""
    paths: list[str] = []
    outer = _SCRATCH.set(paths)
    try:
        yield
    finally:
        _SCRATCH.reset(outer)
        for path in paths:
            storage.remove(spark, path)


def _staged_path(spark: SparkSession, name: str) -> str:
    path = new_work_path(spark, name)
    if (paths := _SCRATCH.get()) is not None:
        paths.append(path)
    return path


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a result that several outputs read, and cut its lineage.

    A written table survives the loss of executors, and each reader scans only
    the columns it needs. Its texts are mostly digits, which zstd stores far shorter.
    """
    spark = df.sparkSession
    path = _staged_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stage_files(rows: DataFrame, files: DataFrame, name: str, then) -> DataFrame:
    """Staged `then(rows)` of the files that `files` names in `file_path`, and no others.

    The names go into the scan's filter, a chunk at a time, so that other files are not
    opened however many are named; each chunk adds to one staged table.
    """
    spark = rows.sparkSession
    path = _staged_path(spark, name)
    then(rows.limit(0)).write.parquet(path)
    names = (r.file_path for r in files.select("file_path").toLocalIterator())
    while chunk := list(itertools.islice(names, FILES_PER_SCAN)):
        then(rows.filter(F.col("file_path").isin(chunk))).write.mode("append").parquet(path)
    return spark.read.schema(then(rows).schema).parquet(path)
