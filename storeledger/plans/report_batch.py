"""The daily batch: every named report to its own result folder."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from storeledger.plans import reports

# Report name -> builder over (good_data, metadata, as_of).
Report = Callable[[DataFrame, DataFrame, reports.AsOf], DataFrame]

REPORTS: dict[str, Report] = {
    "sanity_sample_rows": lambda good, meta, day: reports.sanity_sample_rows(good),
    "single_partition_rows": lambda good, meta, day: reports.single_partition_rows(good, as_of=day),
    "store_daily_revenue": lambda good, meta, day: reports.store_daily_revenue(good),
    "day_store_revenue": lambda good, meta, day: reports.day_store_revenue(good, day),
    "top_products_month": lambda good, meta, day: reports.top_products_month(good, day),
    "rolling_7d_metadata_summary": lambda good, meta, day: reports.rolling_7d_metadata_summary(
        meta, day
    ),
}


def run_reports(
    spark: SparkSession,
    good_data: DataFrame,
    metadata: DataFrame,
    results: str,
    run_date: str | None = None,
    as_of: reports.AsOf = None,
    named: dict[str, Report] | None = None,
) -> DataFrame:
    """Write each report to `query_name=<name>/run_date=<date>/` and list the runs.

    Reports are submitted side by side. A second run on the same date replaces
    the first. Row counts are observed while writing, not counted again.
    """
    named = REPORTS if named is None else named
    if not named:
        raise ValueError("No reports to run")
    run_date = run_date or dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%d")
    results = results.rstrip("/")

    def run(item: tuple[str, Report]) -> tuple[str, str, str, int]:
        name, build = item
        path = f"{results}/query_name={name}/run_date={run_date}"
        seen = Observation(name)
        report = build(good_data, metadata, as_of)
        report.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").option(
            "header", True
        ).csv(path)
        return name, run_date, path, seen.get["rows"]

    with ThreadPoolExecutor(len(named)) as pool:
        runs = list(pool.map(run, named.items()))
    return spark.createDataFrame(
        runs, "query_name STRING, run_date STRING, output_location STRING, rows BIGINT"
    )
