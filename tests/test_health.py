"""Error and latency alarms."""

from __future__ import annotations

import datetime as dt
import math
import random

from pyspark.sql import functions as F

from storeledger.operators import health
from storeledger.streaming.health import failed, outcome_events, streaming_error_alarms

START = dt.datetime(2026, 4, 18, 8, 0)


def _at(minutes):
    return START + dt.timedelta(minutes=minutes)


def test_error_alarm(spark):
    rows = [(_at(m), s) for m, s in [
        (0, "error"), (1, "error"), (4.9, "error"), (5, "error"), (6, "success"), (7, "error"),
        (20, "error"), (21, "error"), (22, "error"), (23, "error")]]
    events = spark.createDataFrame(rows, "ts TIMESTAMP, status STRING")
    alarms = health.error_alarms(events, "ts", F.col("status") == "error").collect()
    assert sorted((a.period_start, a.errors) for a in alarms) == [(_at(0), 3), (_at(20), 4)]


def test_outcomes_feed_the_error_alarm(spark):
    outcomes = spark.createDataFrame(
        [("a", "error", "x"), ("b", "error", "y"), ("c", "error", "z"), ("d", "success", None)],
        "source_key STRING, status STRING, error STRING")
    events = outcome_events(outcomes, F.lit(_at(1)))
    [alarm] = health.error_alarms(events, "ts", failed()).collect()
    assert alarm.errors == 3


def _runs(spark, periods):
    return spark.createDataFrame([(_at(m), float(v)) for m, values in periods for v in values], "ts TIMESTAMP, ms DOUBLE")


def test_latency_alarm_needs_two_periods_in_a_row(spark):
    slow, fast = [240_000], [239_999]
    runs = _runs(spark, [(0, slow), (5, slow), (10, fast), (15, slow), (25, slow), (30, slow), (35, slow)])

    def alarms(**kw):
        return sorted(a.period_start for a in health.latency_alarms(runs, "ts", "ms", **kw).collect())

    assert alarms() == [_at(5), _at(30), _at(35)]
    assert alarms(periods=3) == [_at(35)]
    assert alarms(periods=1) == [_at(m) for m in (0, 5, 15, 25, 30, 35)]


def test_p99_is_the_ranked_value(spark):
    rng = random.Random(3)
    for n in (1, 50, 99, 100, 101, 250):
        values = [rng.randrange(1000) for _ in range(n)]
        p99 = sorted(values)[math.ceil(n * 99 / 100) - 1]
        for threshold in (p99, p99 + 1):
            [row] = health.latency_periods(_runs(spark, [(0, values)]), "ts", "ms", threshold).collect()
            assert (row.runs, row.p99_ms, row.breaching) == (n, p99, p99 >= threshold)


def test_stream_reports_closed_periods(spark, tmp_path):
    source = str(tmp_path / "events")
    rows = [(_at(m), "error") for m in (0, 1, 2, 10, 11, 12, 30)] + [(_at(60), "success")]
    schema = "ts TIMESTAMP, status STRING"
    spark.createDataFrame(rows, schema).write.parquet(source)
    alarms = streaming_error_alarms(spark.readStream.schema(schema).parquet(source), "ts", failed())
    query = (
        alarms.writeStream.format("memory").queryName("alarms_seen")
        .option("checkpointLocation", str(tmp_path / "checkpoint")).trigger(availableNow=True).start()
    )
    query.awaitTermination(120)
    assert sorted((r.period_start, r.errors) for r in spark.table("alarms_seen").collect()) == [(_at(0), 3), (_at(10), 3)]
