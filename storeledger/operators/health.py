"""Health windows: errors and latency per five minutes.

A period without data is healthy in both alarms.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storeledger.contract import (
    ALARM_PERIOD,
    ERROR_ALARM_COUNT,
    LATENCY_ALARM_MS,
    LATENCY_ALARM_PERIODS,
)

# The sketch that brackets a p99 is off by at most one rank in so many.
SKETCH_ACCURACY = 10_000


def errors_per_period(events: DataFrame, at: str, is_error: Column, period: str = ALARM_PERIOD):
    """Error count of the periods with errors.

    `events` may be a stream with a watermark on `at`. Errors are counted rather
    than filtered first, so that the watermark follows all events: the last
    errors are reported even if no further error arrives.
    """
    return (
        events.groupBy(F.window(at, period))
        .agg(F.count_if(is_error).alias("errors"))
        .filter("errors > 0")
        .select(
            F.col("window.start").alias("period_start"),
            F.col("window.end").alias("period_end"),
            "errors",
        )
    )


def error_alarms(
    events: DataFrame,
    at: str,
    is_error: Column,
    threshold: int = ERROR_ALARM_COUNT,
    period: str = ALARM_PERIOD,
) -> DataFrame:
    """Periods with at least `threshold` errors."""
    return errors_per_period(events, at, is_error, period).filter(F.col("errors") >= threshold)


def p99_breaches(duration_ms: str, threshold: float) -> Column:
    """Whether p99 reaches the threshold, as an aggregate: too few runs are below it."""
    below = F.count_if(F.col(duration_ms) < threshold)
    return below < _needed(F.count(duration_ms))


def _counted(runs: DataFrame, at: str, duration_ms: str, threshold: float, period: str):
    """Per period: runs, whether p99 reaches the threshold, and values around p99.

    Whether it does is decided by counting the runs below the threshold.
    """
    around = [0.99 - 2 / SKETCH_ACCURACY, 0.99 + 2 / SKETCH_ACCURACY]
    bracket = F.percentile_approx(duration_ms, around, SKETCH_ACCURACY)
    return (
        runs.groupBy(F.window(at, period))
        .agg(
            F.count(duration_ms).alias("runs"),
            p99_breaches(duration_ms, threshold).alias("breaching"),
            bracket.alias("bracket"),
        )
        .select(
            F.col("window.start").alias("period_start"),
            F.col("window.end").alias("period_end"),
            "runs",
            "breaching",
            F.get("bracket", 0).alias("low"),
            F.get("bracket", 1).alias("high"),
        )
    )


def _needed(runs: Column) -> Column:
    return F.ceil(runs * 99 / 100)


def _with_p99(
    periods: DataFrame, runs: DataFrame, at: str, duration_ms: str, period: str
) -> DataFrame:
    """Add the exact p99 to counted periods, from the runs inside their brackets.

    Runs below a bracket are counted, and those inside it folded by value, before
    the shuffle; only distinct values of a bracket are ever ranked.
    """
    value = F.col(duration_ms)
    bounds = periods.select("period_start", "low", "high")
    placed = (
        runs.filter(value.isNotNull())
        .select(F.window(at, period).alias("window"), value.alias("value"))
        .select(F.col("window.start").alias("period_start"), "value")
    )
    # What lies below the bracket counts under no value.
    inside = placed.join(bounds, "period_start").filter(F.col("value") <= F.col("high")).groupBy(
        "period_start", F.when(F.col("value") >= F.col("low"), F.col("value")).alias("value")
    ).agg(F.count(F.lit(1)).alias("n"))
    upward = Window.partitionBy("period_start").orderBy(F.col("value").asc_nulls_first())
    reached = inside.withColumn("rank", F.sum("n").over(upward))
    reached = reached.join(periods.select("period_start", "runs"), "period_start").filter(
        F.col("value").isNotNull() & (F.col("rank") >= _needed(F.col("runs")))
    )
    p99 = reached.groupBy("period_start").agg(F.min("value").alias("p99_ms"))
    return periods.join(p99, "period_start", "left").select(
        "period_start", "period_end", "runs", "p99_ms", "breaching"
    )


def latency_periods(
    runs: DataFrame,
    at: str,
    duration_ms: str,
    threshold: float = LATENCY_ALARM_MS,
    period: str = ALARM_PERIOD,
) -> DataFrame:
    """Runs, p99 and whether p99 reaches the threshold, per period.

    p99 is the smallest duration that 99% of the runs do not exceed, exactly, for
    periods of any size; no period's durations are ever gathered.
    """
    counted = _counted(runs, at, duration_ms, threshold, period)
    return _with_p99(counted, runs, at, duration_ms, period)


def latency_alarms(
    runs: DataFrame,
    at: str,
    duration_ms: str,
    threshold: float = LATENCY_ALARM_MS,
    periods: int = LATENCY_ALARM_PERIODS,
    period: str = ALARM_PERIOD,
) -> DataFrame:
    """Breaching periods that directly follow `periods` - 1 breaching ones.

    One scan finds them: a breaching period stands under its own start and under
    those of the next ones; a start with all of them is an alarm. Another scan
    takes the p99 of the alarms alone.
    """
    breaching = _counted(runs, at, duration_ms, threshold, period).filter("breaching")
    span = F.col("period_end") - F.col("period_start")
    steps = F.array(*[F.col("period_start") + span * i for i in range(periods)])
    own = F.when(F.col("start") == F.col("period_start"), F.struct(*breaching.columns))
    alarms = (
        breaching.withColumn("start", F.explode(steps))
        .groupBy("start")
        .agg(F.count(F.lit(1)).alias("together"), F.max(own).alias("own"))
        .filter((F.col("together") == periods) & F.col("own").isNotNull())
        .select("own.*")
    )
    return _with_p99(alarms, runs, at, duration_ms, period).drop("breaching")
