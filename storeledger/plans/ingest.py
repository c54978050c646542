"""The batch job: landing zone to good_data, errors, metadata, outcomes and alerts."""

from __future__ import annotations

import datetime as dt
import itertools
import time
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storeledger.contract import (
    ALERTS_PATH,
    BAD_DATA_PATH,
    CUSTOMER_ORDERS_PATH,
    DEFAULT_ERROR_THRESHOLD,
    GOOD_DATA_PATH,
    METADATA_PATH,
    OUTCOMES_PATH,
)
from storeledger.operators import alerts, summary, validate, verdicts
from storeledger.plans import sinks, storage
from storeledger.plans.staging import stage
from storeledger.session import bounded_tasks, new_work_path
from storeledger.sources import ledger
from storeledger.sources.landing import Landing, changed_uploads, file_verdicts, raw_rows
from storeledger.sources.names import decoded, object_key, source_key, with_partition

# File-system calls side by side that look whether named uploads exist.
EXISTENCE_CHECKS = 16


@dataclass
class Ingested:
    """What one run found. All tables are staged and can be read again."""

    outcomes: DataFrame
    validated: DataFrame
    summaries: DataFrame
    customers: DataFrame
    high_error_alerts: DataFrame
    failure_alerts: DataFrame
    files: DataFrame

    def results(self) -> DataFrame:
        """Per upload: status, and either its summary or its error."""
        whole = summary.with_customers(self.summaries, self.customers)
        packed = whole.select("source_key", F.struct(*whole.columns).alias("summary"))
        return self.outcomes.select("source_key", "status", "error").join(
            packed, "source_key", "left"
        )


def examine(
    spark: SparkSession,
    paths: str | list[str],
    arrived_by: dt.datetime | None = None,
    threshold: float = DEFAULT_ERROR_THRESHOLD,
    source_bucket: str | None = None,
    expected: DataFrame | None = None,
) -> Ingested:
    """Read and judge every upload; write nothing but staged tables.

    `paths` is a landing folder, or a list of uploads; those of the list that are gone
    have an error outcome and don't stop the others. Spark's file sources don't show empty
    files. Uploads that `expected` (column source_key) names and the landing zone doesn't
    show have the outcome of one.
    """
    with bounded_tasks(spark):
        return _examine(spark, paths, arrived_by, threshold, source_bucket, expected)


def _examine(
    spark: SparkSession,
    paths: str | list[str],
    arrived_by: dt.datetime | None,
    threshold: float,
    source_bucket: str | None,
    expected: DataFrame | None,
) -> Ingested:
    started = time.monotonic()
    now = dt.datetime.now(dt.timezone.utc)
    if source_bucket is None:
        source_bucket = urlparse(paths if isinstance(paths, str) else paths[0]).netloc
    missing = None
    if not isinstance(paths, str):
        paths, missing = _there(spark, paths)
    landing = Landing(paths, arrived_by or now)

    listed = stage(landing.present(spark), "listed")
    files = file_verdicts(spark, landing)
    validated = stage(
        validate.validate(
            raw_rows(spark, landing, files), carry_max=("overlong",), staged=True
        ),
        "validated",
    )
    judged = verdicts.outcomes(files, verdicts.row_findings(validated))
    judged = verdicts.refuse_changed(judged, changed_uploads(spark, landing, listed))
    if missing is not None:
        judged = judged.unionByName(verdicts.unseen(missing, judged, verdicts.MISSING))
    if expected is not None:
        judged = judged.unionByName(verdicts.unseen(expected, judged))
    outcomes = stage(judged, "outcomes")

    accepted = outcomes.filter("status = 'success'")
    kept = without(validated, outcomes.filter("status = 'error'"))
    stamp = F.lit(now.isoformat())
    elapsed = F.lit((time.monotonic() - started) * 1000)
    summaries = stage(summary.file_summary(kept, stamp, elapsed, files=accepted), "summaries")
    return Ingested(
        outcomes=outcomes,
        validated=kept,
        summaries=summaries,
        customers=stage(summary.customer_orders(kept), "customers"),
        high_error_alerts=alerts.high_error_alerts(summaries, source_bucket, stamp, threshold),
        failure_alerts=alerts.failure_alerts(outcomes, source_bucket, stamp),
        files=listed.select("*", landing.of_upload()),
    )


def _there(spark: SparkSession, paths: list[str]) -> tuple[list[str], DataFrame]:
    """The named uploads that exist, and the others as (source_key).

    Only names pass the driver, as many as the caller gave. With none left, the scans
    read an empty folder.
    """
    with ThreadPoolExecutor(EXISTENCE_CHECKS) as pool:
        found = list(pool.map(lambda p: storage.exists(spark, p), paths))
    gone = [storage.qualified(spark, p) for p, there in zip(paths, found) if not there]
    there = [p for p, is_there in zip(paths, found) if is_there]
    if not there:
        there = [new_work_path(spark, "no-uploads")]
        storage.make_folder(spark, there[0])
    named = spark.createDataFrame([(p,) for p in gone], "path string")
    return there, named.select(object_key(source_key(F.col("path"))).alias("source_key"))


def ingest(
    spark: SparkSession,
    paths: str | list[str],
    output: str,
    run_id: str | None = None,
    **settings,
) -> Ingested:
    """Judge every upload and let the accepted ones stand for their store and date.

    The run's tables lie in folders of their own; nobody sees them until the ledger's
    commit, the last thing that is written. A run that fails before leaves every table
    as it was, and is repaired by running it again. Where several uploads share a store
    and date, the latest stands, also across runs. Outcomes and alerts are written under
    `run_id` (default: the time), so that a run repeated under its id leaves one set.
    """
    run_id = run_id or f"{dt.datetime.now(dt.timezone.utc):%Y%m%dT%H%M%S.%fZ}"
    version = f"{run_id}-{uuid.uuid4().hex[:8]}"  # A repeated run is another version.
    with bounded_tasks(spark):
        return _ingest(spark, paths, output.rstrip("/"), run_id, version, **settings)


def _ingest(
    spark: SparkSession,
    paths: str | list[str],
    output: str,
    run_id: str,
    version: str,
    **settings,
) -> Ingested:
    found = examine(spark, paths, **settings)
    accepted = found.outcomes.filter("status = 'success'")
    latest = stage(_standing(spark, accepted, output), "latest")
    superseded = accepted.join(latest, "source_key", "left_anti")
    current = without(found.validated, stage(superseded, "superseded"))

    good = with_partition(validate.stored_good_rows(current))
    sinks.write_good_data(good, f"{output}/{GOOD_DATA_PATH}", version)
    bad = with_partition(validate.bad_rows(current))
    sinks.write_bad_data(bad, f"{output}/{BAD_DATA_PATH}", version)
    customers = latest.join(found.customers, "source_key")
    sinks.write_customer_orders(customers, f"{output}/{CUSTOMER_ORDERS_PATH}", version)
    records = latest.join(found.summaries, "source_key")
    sinks.write_metadata(records, f"{output}/{METADATA_PATH}", version)
    sinks.write_outcomes(found.outcomes, run_id, f"{output}/{OUTCOMES_PATH}")
    raised = [found.high_error_alerts, found.failure_alerts]
    sinks.write_alerts(raised, run_id, f"{output}/{ALERTS_PATH}")
    ledger.commit(found.outcomes, found.summaries, found.files, version, output)
    return found


def _standing(spark: SparkSession, accepted: DataFrame, output: str) -> DataFrame:
    """The accepted uploads that stand now: the latest, and not older than what stood."""
    taken = ledger.standing(ledger.uploads(spark, output)).select(
        "store", "date", F.struct("modified_at", "source_key").alias("stood")
    )
    latest = verdicts.latest_uploads(accepted).join(
        accepted.select("source_key", "modified_at"), "source_key"
    )
    mine = F.struct("modified_at", "source_key")
    return (
        latest.join(taken, ["store", "date"], "left")
        .filter(F.col("stood").isNull() | (mine >= F.col("stood")))
        .select("store", "date", "source_key")
    )


def ingest_changes(
    spark: SparkSession,
    landing: str,
    output: str,
    max_uploads: int = 10_000,
    run_id: str | None = None,
    **settings,
) -> list[Ingested]:
    """Ingest what is new in a landing folder: uploads with a file no run took as it is now.

    A file is known by path, time and length, so one that is rewritten under its path is
    news, and its upload is read again. The ledger remembers; nothing else need be kept.
    Uploads are taken in runs of at most `max_uploads`, whose names pass the driver.
    """
    settings.setdefault("arrived_by", dt.datetime.now(dt.timezone.utc))
    zone = Landing(landing, settings["arrived_by"])
    files = zone.present(spark)
    known = ledger.taken_files(spark, output).select("file_path", "modified_at", "length")
    news = files.join(known.distinct(), ["file_path", "modified_at", "length"], "left_anti")
    path = source_key(decoded(F.col("file_path"))).alias("path")
    names = stage(news.select(path).distinct().orderBy("path"), "news").toLocalIterator()
    run_id = run_id or f"{dt.datetime.now(dt.timezone.utc):%Y%m%dT%H%M%S.%fZ}"
    runs = []
    for number in itertools.count():
        chosen = [row.path for row in itertools.islice(names, max_uploads)]
        if not chosen:
            return runs
        runs.append(ingest(spark, chosen, output, f"{run_id}-{number:06d}", **settings))


def without(rows: DataFrame, uploads: DataFrame) -> DataFrame:
    """Rows of all other uploads; the size of `uploads` decides how they are joined."""
    return rows.join(uploads.select("source_key"), "source_key", "left_anti")
