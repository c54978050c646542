"""Time the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from storeledger.plans import catalog
from storeledger.plans.ingest import ingest
from storeledger.session import build_session, new_work_path
from storeledger.sources.workload import write_landing_zone

HEADLINES = (
    "validated_rows",
    "bad_rows",
    "error_profile",
    "row_counters",
    "daily_revenue",
    "top_products",
    "orders_per_customer",
    "file_summary",
    "overall_metrics",
    "report_store_daily",
    "report_day_store",
    "report_top_month",
    "report_rolling_7d",
    "latest_file_wins",
    "error_alarm_5m",
    "p99_alarm_5m",
)
RUNS = 2


def _seconds(action) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus if cpus.isdigit() else 8,
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="12g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    registered = catalog.queries()

    def run(name: str) -> None:
        registered[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

    run("row_counters")  # Starts the JVM's compilers; not timed.
    seconds = {n: min(_seconds(lambda: run(n)) for _ in range(RUNS)) for n in HEADLINES}

    # The whole job, landing zone to tables. Writing the landing zone is not timed.
    landing = new_work_path(spark, "bench-landing")
    write_landing_zone(spark, sf_dir, landing)
    seconds["ingest"] = min(
        _seconds(lambda: ingest(spark, landing, new_work_path(spark, "bench-tables")))
        for _ in range(RUNS)
    )
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": {n: round(s, 3) for n, s in seconds.items()},
                "sf": os.path.basename(sf_dir).removeprefix("sf"),
            }
        )
    )
    sys.stdout.flush()
    spark.stop()


if __name__ == "__main__":
    main()
