"""Alert records: high error rate and failed files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storeledger.contract import DEFAULT_ERROR_THRESHOLD, FAILURE_EVENT, HIGH_ERROR_EVENT


def high_error_alerts(
    counters: DataFrame,
    source_bucket: str,
    occurred_at: Column,
    threshold: float = DEFAULT_ERROR_THRESHOLD,
) -> DataFrame:
    """Files whose rounded bad-row rate reaches the threshold."""
    return counters.filter(F.col("bad_row_rate") >= threshold).select(
        F.lit(HIGH_ERROR_EVENT).alias("event_type"),
        F.lit(source_bucket).alias("source_bucket"),
        "source_key",
        "bad_row_rate",
        F.lit(float(threshold)).alias("threshold"),
        "bad_rows",
        "total_rows",
        occurred_at.alias("occurred_at"),
    )


def failure_alerts(outcomes: DataFrame, source_bucket: str, occurred_at: Column) -> DataFrame:
    """Files that were rejected, with the reason."""
    return outcomes.filter(F.col("status") == "error").select(
        F.lit(FAILURE_EVENT).alias("event_type"),
        F.lit(source_bucket).alias("source_bucket"),
        "source_key",
        "error",
        occurred_at.alias("occurred_at"),
    )
