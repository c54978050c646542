"""Session settings the jobs are written for."""

from __future__ import annotations

import contextlib
import os
import re
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import SparkSession

# What one task of a large job is given to read, from files or from a shuffle. A row that is
# folded takes some ten times its stored size in memory, and every core holds its own.
TASK_BYTES = 32 << 20
_TASK_SIZES = (
    "spark.sql.files.maxPartitionBytes",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes",
)
_UNITS = {"": 0, "k": 10, "m": 20, "g": 30, "t": 40, "p": 50}


def build_session(app_name: str = "storeledger", master: str | None = None, **conf) -> SparkSession:
    """A session with adaptive execution and a UTC clock.

    Shuffle width is left to the cluster: adaptive execution coalesces small
    partitions and splits skewed ones, so set `spark.sql.shuffle.partitions`
    high for large inputs.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    }
    settings.update({k.replace("__", "."): str(v) for k, v in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextlib.contextmanager
def bounded_tasks(spark: SparkSession) -> Iterator[None]:
    """Jobs that run inside the block have tasks of at most TASK_BYTES, where Spark can cut.

    By Spark's own sizes a task's sorted and folded rows outgrow its share of the memory on
    large inputs, and spill. Sizes that are set smaller stay.
    """
    before = {name: spark.conf.get(name) for name in _TASK_SIZES}
    try:
        for name, size in before.items():
            if _bytes(size) > TASK_BYTES:
                spark.conf.set(name, f"{TASK_BYTES}b")
        yield
    finally:
        for name, size in before.items():
            spark.conf.set(name, size)


def _bytes(size: str) -> int:
    """A size as Spark's settings write it."""
    number, unit = re.fullmatch(r"(\d+)([kmgtp]?)b?", size.strip().lower()).groups()
    return int(number) << _UNITS[unit]


def work_root(spark: SparkSession) -> str:
    """The shared folder for staged tables: `spark.checkpoint.dir` of the session.

    Where it is unset, a session in one JVM gets a temporary folder; on a cluster it is
    the session's warehouse, which all executors share.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if not folder:
        if re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            folder = os.path.join(tempfile.gettempdir(), "storeledger-work")
        else:
            folder = spark.conf.get("spark.sql.warehouse.dir")
    return folder.rstrip("/")


def new_work_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared work folder."""
    return f"{work_root(spark)}/storeledger/{name}-{uuid.uuid4().hex}"
