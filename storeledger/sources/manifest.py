"""Result files as records: one per CSV, from file names and sizes alone."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storeledger.contract import RESULT_EVENT
from storeledger.plans import storage
from storeledger.plans.staging import stage
from storeledger.sources.names import object_key


def _listing(spark: SparkSession, root: str) -> DataFrame:
    """Path, size and time of every file; contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(root)
        .select("path", "length", "modificationTime")
    )


def _is_result():
    return F.col("path").endswith(".csv")


def result_manifest(spark: SparkSession, root: str) -> DataFrame:
    """One record per result CSV below `root`."""
    stamp = F.date_format(
        F.to_utc_timestamp("modificationTime", F.current_timezone()),
        "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'",
    )
    return _listing(spark, root).filter(_is_result()).select(
        F.lit(RESULT_EVENT).alias("event_type"),
        F.regexp_extract("path", r"^[A-Za-z0-9+.-]+://([^/]+)/", 1).alias("bucket"),
        object_key(F.col("path")).alias("key"),
        F.col("length").alias("size_bytes"),
        F.col("path").alias("s3_uri"),
        stamp.alias("created_at"),
    )


def new_results(spark: SparkSession, root: str, told: str) -> DataFrame:
    """Records of the result CSVs that were not told before; each is told once.

    `told` is a table of what was told, kept between runs. A result is known by key, size
    and time, so one that is written again is told again.
    """
    records = result_manifest(spark, root)
    known = ["key", "size_bytes", "created_at"]
    if storage.exists(spark, told):
        before = spark.read.schema(records.schema).parquet(told).select(*known).distinct()
        records = records.join(before, known, "left_anti").select(*records.columns)
    news = stage(records, "new-results")
    news.write.mode("append").parquet(told)
    return news


@dataclass
class ManifestCounts:
    published: int
    skipped: int


def manifest_counts(spark: SparkSession, root: str) -> ManifestCounts:
    """Files reported and files passed over because they are not results."""
    row = (
        _listing(spark, root)
        .agg(F.count_if(_is_result()).alias("published"), F.count(F.lit(1)).alias("files"))
        .first()
    )
    return ManifestCounts(row.published, row.files - row.published)
