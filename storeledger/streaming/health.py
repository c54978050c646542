"""Alarms over an event stream, and the stream of run outcomes that feeds them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from storeledger.contract import (
    ALARM_PERIOD,
    ALERTS_PATH,
    ALERTS_SCHEMA,
    ERROR_ALARM_COUNT,
    LATENCY_ALARM_MS,
    LATENCY_ALARM_PERIODS,
)
from storeledger.operators.health import SKETCH_ACCURACY, error_alarms, p99_breaches


def streaming_error_alarms(
    events: DataFrame,
    at: str,
    is_error: Column,
    lateness: str = ALARM_PERIOD,
    threshold: int = ERROR_ALARM_COUNT,
) -> DataFrame:
    """Error alarms of a stream; a period is reported once the watermark passes it.

    State is one counter per open period.
    """
    return error_alarms(events.withWatermark(at, lateness), at, is_error, threshold)


def streaming_latency_alarms(
    runs: DataFrame,
    at: str,
    duration_ms: str,
    threshold: float = LATENCY_ALARM_MS,
    periods: int = LATENCY_ALARM_PERIODS,
    period: str = ALARM_PERIOD,
    lateness: str = ALARM_PERIOD,
) -> DataFrame:
    """Breaching periods that directly follow `periods` - 1 breaching ones, of a stream.

    Whether a period's p99 reaches the threshold is counted, so it is exact; p99_ms is a
    sketch's, off by at most one rank in 10,000. Closed periods go on to a second window
    of `periods` of them, which slides by one and remembers the ones before: state is a
    few counters and a sketch per open period. An alarm is given once the watermark
    passes its period.
    """
    value = F.col(duration_ms)
    counted = (
        runs.withWatermark(at, lateness)
        .groupBy(F.window(at, period))
        .agg(
            F.count(value).alias("runs"),
            p99_breaches(duration_ms, threshold).alias("breaching"),
            F.percentile_approx(value, 0.99, SKETCH_ACCURACY).alias("p99_ms"),
        )
    )
    number, unit = period.split(maxsplit=1)
    span = f"{int(number) * periods} {unit}"
    breaching = counted.filter("breaching").select("window", "runs", "p99_ms")
    last = F.struct(F.window_time("window").alias("at"), "runs", "p99_ms")
    return (
        breaching.withColumn("last", last)
        .groupBy(F.window("window", span, period).alias("window"))
        .agg(F.count(F.lit(1)).alias("together"), F.max("last").alias("last"))
        .filter(F.col("together") == periods)
        .select(
            (F.col("window.end") - F.expr(f"INTERVAL {period}")).alias("period_start"),
            F.col("window.end").alias("period_end"),
            "last.runs",
            "last.p99_ms",
        )
    )


def failure_events(spark: SparkSession, output: str) -> DataFrame:
    """The failed uploads of an output's runs as a stream of timed events.

    Every run adds a folder of alerts; a stream takes each once. Its `ts` is when the run
    judged the upload, for `streaming_error_alarms` or counts per period.
    """
    raised = spark.readStream.schema(ALERTS_SCHEMA).parquet(f"{output.rstrip('/')}/{ALERTS_PATH}")
    return raised.filter("event_type = 'pipeline_failure'").select(
        F.to_timestamp("occurred_at").alias("ts"), "source_key", F.lit("error").alias("status"), "error"
    )


def outcome_events(outcomes: DataFrame, occurred_at: Column) -> DataFrame:
    """File outcomes as timed events for the error alarm."""
    return outcomes.select(occurred_at.alias("ts"), "source_key", "status", "error")


def failed() -> Column:
    return F.col("status") == "error"
