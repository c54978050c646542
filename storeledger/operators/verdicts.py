"""Per-upload verdicts: accepted or refused, and why.

Rules apply in this order, the first failure names the error: changed while read,
encoding, row width, header, order dates, file name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storeledger.functions import order_day, order_day_layout
from storeledger.operators.validate import is_good
from storeledger.sources.names import file_date_of, name_error, store_of

CHANGED = "File changed while it was read"
MISSING = "File was removed before it was read"
UNDECODABLE = "File is not valid UTF-8"
# Fixed value: the message for a file without any header line.
NO_COLUMNS = "No columns to parse from file"
OVERLONG = "Row with more fields than the header"
MIXED_DATES = "order_date values of good rows use more than one format"


def row_findings(validated: DataFrame) -> DataFrame:
    """Per upload: an overlong row, unreadable dates or mixed date layouts in good rows."""
    day, layout = F.col("order_date"), F.xxhash64(order_day_layout(F.col("order_date")))
    good_layout = F.when(is_good(), layout)
    return validated.groupBy("source_key").agg(
        F.max("overlong").alias("overlong"),
        F.count_if(is_good() & order_day(day).isNull()).alias("unreadable_dates"),
        (F.min(good_layout) != F.max(good_layout)).alias("mixed_dates"),
    )


def outcomes(files: DataFrame, findings: DataFrame) -> DataFrame:
    """One row per upload: store, date, modification time, status and error.

    Starts from the files, so that a file without rows has an outcome too.
    """
    uploads = files.groupBy("source_key").agg(
        F.max("modified_at").alias("modified_at"),
        F.bool_or("undecodable").alias("undecodable"),
        F.min("header_error").alias("header_error"),
    )
    key = F.col("source_key")
    unreadable = F.concat(
        F.lit("order_date cannot be read as a date in "),
        F.col("unreadable_dates"),
        F.lit(" good row(s)"),
    )
    error = F.coalesce(
        F.when(F.col("undecodable"), F.lit(UNDECODABLE)),
        F.when(F.col("overlong") > 0, F.lit(OVERLONG)),
        F.col("header_error"),
        F.when(F.col("unreadable_dates") > 0, unreadable),
        F.when(F.col("mixed_dates"), F.lit(MIXED_DATES)),
        name_error(key),
    )
    return uploads.join(findings, "source_key", "left").select(
        "source_key",
        store_of(key).alias("store"),
        file_date_of(key).alias("date"),
        "modified_at",
        F.when(error.isNull(), F.lit("success")).otherwise(F.lit("error")).alias("status"),
        error.alias("error"),
    )


def refuse_changed(judged: DataFrame, changed: DataFrame) -> DataFrame:
    """Outcomes with an error for each upload that `changed` (source_key) names."""
    marked = judged.join(changed.withColumn("_changed", F.lit(True)), "source_key", "left")
    is_changed = F.col("_changed").isNotNull()
    return marked.select(
        "source_key",
        "store",
        "date",
        "modified_at",
        F.when(is_changed, F.lit("error")).otherwise(F.col("status")).alias("status"),
        F.when(is_changed, F.lit(CHANGED)).otherwise(F.col("error")).alias("error"),
    )


def unseen(expected: DataFrame, judged: DataFrame, error: str = NO_COLUMNS) -> DataFrame:
    """Outcomes of expected uploads that no file stands for; by default, nothing to parse."""
    key = F.col("source_key")
    return (
        expected.select("source_key").distinct().join(judged, "source_key", "left_anti").select(
            "source_key",
            store_of(key).alias("store"),
            file_date_of(key).alias("date"),
            F.lit(None).cast("timestamp").alias("modified_at"),
            F.lit("error").alias("status"),
            F.lit(error).alias("error"),
        )
    )


def latest_uploads(accepted: DataFrame) -> DataFrame:
    """The upload that stands for each store and date: the latest, then the greatest key."""
    latest = F.max(F.struct("modified_at", "source_key"))
    return (
        accepted.groupBy("store", "date")
        .agg(latest.alias("latest"))
        .select("store", "date", F.col("latest.source_key").alias("source_key"))
    )
