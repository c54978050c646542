"""Registered queries over the order tables, each with its SQL where SQL can say it."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storeledger.contract import DEFAULT_ERROR_THRESHOLD, INPUT_COLUMNS
from storeledger.operators import alerts, health, metrics, summary, validate, verdicts
from storeledger.plans import reports, sinks, storage
from storeledger.plans.ingest import Ingested, examine, ingest, ingest_changes
from storeledger.plans.report_batch import run_reports
from storeledger.plans.staging import stage
from storeledger.session import bounded_tasks, new_work_path
from storeledger.sources import landing, manifest, names, tables
from storeledger.sources.workload import (
    CORRECTED_BELOW,
    OUTCOMES_SQL,
    VALIDATED_SQL,
    sales_raw,
    sales_raw_sql,
    table,
    write_landing_zone,
)
from storeledger.streaming.arrivals import ingest_arrivals
from storeledger.streaming.health import (
    failure_events,
    streaming_error_alarms,
    streaming_latency_alarms,
)

Query = Callable[[SparkSession, str], DataFrame]

# Report day inside the range of the order tables.
AS_OF = "1998-06-01"
# A file date of the yearly landing zone.
BATCH_DAY = "1998-01-01"

_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def add(build: Query) -> Query:
        _QUERIES[name] = build
        if sql is not None:
            _SQL[name] = sql
        return build

    return add


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def _sql(body: str, *more: str) -> str:
    """Prefix a SELECT with the shared common table expressions."""
    return "WITH " + ",".join([sales_raw_sql(), VALIDATED_SQL, *more]) + "\n" + body


def validated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.validate(sales_raw(spark, sf_dir))


# Tables written for the registered queries of one application, by name.
_KEPT: dict[tuple[str, str, str], str] = {}


def _kept(spark: SparkSession, sf_dir: str, name: str, write: Callable[[str], None]) -> str:
    """The path of a derived table, written by the first query that reads it."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _KEPT or not storage.exists(spark, _KEPT[key]):
        path = new_work_path(spark, name)
        with bounded_tasks(spark):
            write(path)
        _KEPT[key] = path
    return _KEPT[key]


def _catalogued(
    spark: SparkSession, sf_dir: str, kind: tables.Kind, write: Callable[[str], None]
) -> DataFrame:
    """A derived table as the catalogue knows it, written and registered once."""

    def write_and_register(path: str) -> None:
        write(path)
        name = tables.table_name(spark, path, kind)
        tables.create_table(spark, name, path, kind)
        tables.refresh_partitions(spark, name)

    path = _kept(spark, sf_dir, kind.path.replace("/", "-"), write_and_register)
    return spark.table(tables.table_name(spark, path, kind))


def good_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The good_data table as the sink writes it, partitioned by store and date."""
    rows = names.with_partition(validate.stored_good_rows(validated(spark, sf_dir)))
    return _catalogued(spark, sf_dir, tables.GOOD_DATA, lambda p: sinks.write_good_data(rows, p))


_ROW = ", ".join(INPUT_COLUMNS)


# --- Row rules ----------------------------------------------------------------------

@register("validated_rows", _sql(f"SELECT source_key, {_ROW}, validation_errors FROM validated"))
def validated_rows(spark, sf_dir):
    return validate.validated_rows(validated(spark, sf_dir))


def _rows_with(codes: tuple[str, ...]) -> Query:
    def build(spark, sf_dir):
        rows = validate.bad_rows(validated(spark, sf_dir))
        found = F.arrays_overlap(F.split("validation_errors", ";"), F.array(*map(F.lit, codes)))
        return rows.filter(found)

    return build


def _rows_with_sql(codes: tuple[str, ...]) -> str:
    listed = ", ".join(f"'{c}'" for c in codes)
    return _sql(
        f"SELECT source_key, {_ROW}, validation_errors FROM bad "
        f"WHERE list_has_any(string_split(validation_errors, ';'), [{listed}])"
    )


for _name, _codes in {
    "duplicate_rows": ("duplicate_row",),
    "missing_fields": tuple(f"missing_{c}" for c in validate.REQUIRED_TEXT_COLUMNS),
    "numeric_checks": (
        "missing_quantity",
        "non_positive_quantity",
        "missing_unit_price",
        "non_positive_unit_price",
    ),
    "status_check": ("invalid_payment_status",),
}.items():
    register(_name, _rows_with_sql(_codes))(_rows_with(_codes))


@register("good_rows", _sql(f"SELECT source_key, {_ROW} FROM good"))
def good_rows(spark, sf_dir):
    return validate.stored_good_rows(validated(spark, sf_dir))


@register("bad_rows", _sql(f"SELECT source_key, {_ROW}, validation_errors FROM bad"))
def bad_rows(spark, sf_dir):
    return validate.bad_rows(validated(spark, sf_dir))


@register(
    "error_profile",
    _sql(
        "SELECT source_key, code, COUNT(*) AS rows FROM "
        "(SELECT source_key, unnest(string_split(validation_errors, ';')) AS code FROM bad) "
        "GROUP BY source_key, code"
    ),
)
def error_profile(spark, sf_dir):
    return validate.error_profile(validated(spark, sf_dir))


# --- Metrics --------------------------------------------------------------------------

_MONEY = "CAST(SUM(exact_revenue) AS DOUBLE)"

_DAILY = f"""daily AS (
  SELECT source_key, order_date, {_MONEY} AS daily_revenue FROM good GROUP BY ALL
)"""
_TOP = f"""top AS (
  SELECT source_key, product_id, total_revenue, rank FROM (
    SELECT *, row_number() OVER (PARTITION BY source_key ORDER BY total_revenue DESC, product_id) AS rank
    FROM (SELECT source_key, product_id, {_MONEY} AS total_revenue FROM good GROUP BY ALL)
  ) WHERE rank <= 10
)"""
_CUSTOMERS = """customers AS (
  SELECT source_key, customer_id, COUNT(DISTINCT order_id) AS order_count FROM good GROUP BY ALL
)"""
_COUNTERS = """counters AS (
  SELECT *, total_rows - good_rows AS bad_rows,
    CASE WHEN total_rows > 0 THEN round_even((total_rows - good_rows) / total_rows, 4) ELSE 0.0 END AS bad_row_rate,
    CASE WHEN good_rows > 0 THEN round_even(paid_rows / good_rows, 4) ELSE 0.0 END AS payment_success_rate
  FROM (
    SELECT source_key, any_value(store) AS store, any_value("date") AS "date",
      COUNT(*) AS total_rows,
      COUNT(*) FILTER (validation_errors = '') AS good_rows,
      COUNT(*) FILTER (validation_errors = '' AND lower(payment_status) = 'paid') AS paid_rows
    FROM validated GROUP BY source_key
  )
)"""


@register("daily_revenue", _sql("SELECT source_key, order_date, daily_revenue FROM daily", _DAILY))
def daily_revenue(spark, sf_dir):
    return metrics.daily_revenue(validate.good_rows(validated(spark, sf_dir)))


@register("top_products", _sql("SELECT source_key, product_id, total_revenue, rank FROM top", _TOP))
def top_products(spark, sf_dir):
    return metrics.top_products(validate.good_rows(validated(spark, sf_dir)))


@register(
    "orders_per_customer",
    _sql("SELECT source_key, customer_id, order_count FROM customers", _CUSTOMERS),
)
def orders_per_customer(spark, sf_dir):
    return metrics.orders_per_customer(validate.good_rows(validated(spark, sf_dir)))


@register(
    "payment_success_rate",
    _sql("SELECT source_key, payment_success_rate FROM counters WHERE good_rows > 0", _COUNTERS),
)
def payment_success_rate(spark, sf_dir):
    return metrics.payment_success_rate(validate.good_rows(validated(spark, sf_dir)))


@register(
    "row_counters",
    _sql(
        "SELECT source_key, total_rows, good_rows, bad_rows, bad_row_rate, payment_success_rate "
        "FROM counters",
        _COUNTERS,
    ),
)
def row_counters(spark, sf_dir):
    return metrics.row_counters(validated(spark, sf_dir))


@register(
    "file_summary",
    _sql(
        """SELECT source_key, total_rows, good_rows, bad_rows, bad_row_rate, payment_success_rate,
  list, item, amount
FROM counters LEFT JOIN (
  SELECT source_key, 'daily_revenue' AS list, order_date AS item, daily_revenue AS amount FROM daily
  UNION ALL SELECT source_key, 'top_products', product_id, total_revenue FROM top
  UNION ALL SELECT source_key, 'orders_per_customer', customer_id, order_count::DOUBLE FROM customers
) USING (source_key)""",
        _DAILY,
        _TOP,
        _CUSTOMERS,
        _COUNTERS,
    ),
)
def file_summary(spark, sf_dir):
    rows = stage(validated(spark, sf_dir), "validated")
    records = summary.with_customers(
        summary.file_summary(rows, F.lit("-"), F.lit(0.0)), summary.customer_orders(rows)
    )

    def entries(name: str, item: str, amount: str):
        return F.transform(
            name,
            lambda e: F.struct(
                F.lit(name).alias("list"), e[item].alias("item"), e[amount].cast("double").alias("amount")
            ),
        )

    every = F.concat(
        entries("daily_revenue", "order_date", "daily_revenue"),
        entries("top_products", "product_id", "total_revenue"),
        entries("orders_per_customer", "customer_id", "order_count"),
    )
    counters = ("source_key", "total_rows", "good_rows", "bad_rows", "bad_row_rate")
    return records.select(
        *counters, "payment_success_rate", F.inline_outer(every)
    )


@register(
    "overall_metrics",
    _sql(
        f"""SELECT COUNT(*) AS total_rows,
  COUNT(*) FILTER (validation_errors = '') AS good_rows,
  COUNT(*) FILTER (validation_errors <> '') AS bad_rows,
  round_even(COUNT(*) FILTER (validation_errors <> '') / COUNT(*), 4) AS bad_row_rate,
  round_even(COUNT(*) FILTER (validation_errors = '' AND lower(payment_status) = 'paid')
    / COUNT(*) FILTER (validation_errors = ''), 4) AS payment_success_rate,
  CAST(SUM(exact_revenue) FILTER (validation_errors = '') AS DOUBLE) AS revenue
FROM validated"""
    ),
)
def overall_metrics(spark, sf_dir):
    return metrics.overall_metrics(validated(spark, sf_dir))


@register(
    "overall_daily_revenue",
    _sql(f"SELECT order_date, {_MONEY} AS daily_revenue FROM good GROUP BY ALL"),
)
def overall_daily_revenue(spark, sf_dir):
    return metrics.daily_revenue(validate.good_rows(validated(spark, sf_dir)), keys=())


@register(
    "overall_top_products",
    _sql(
        f"SELECT product_id, {_MONEY} AS total_revenue FROM good GROUP BY ALL "
        "ORDER BY total_revenue DESC, product_id LIMIT 10"
    ),
)
def overall_top_products(spark, sf_dir):
    return metrics.top_products(validate.good_rows(validated(spark, sf_dir)), keys=())


@register(
    "overall_orders_per_customer",
    _sql("SELECT customer_id, COUNT(DISTINCT order_id) AS order_count FROM good GROUP BY ALL"),
)
def overall_orders_per_customer(spark, sf_dir):
    return metrics.orders_per_customer(validate.good_rows(validated(spark, sf_dir)), keys=())


# --- Alerts ---------------------------------------------------------------------------

@register(
    "high_error_alerts",
    _sql(
        """SELECT 'high_error_rate' AS event_type, 'landing' AS source_bucket, source_key, bad_row_rate,
  0.20 AS threshold, bad_rows, total_rows, '1998-06-01T00:00:00+00:00' AS occurred_at
FROM counters WHERE bad_row_rate >= 0.20""",
        _COUNTERS,
    ),
)
def high_error_alerts(spark, sf_dir):
    counters = metrics.row_counters(validated(spark, sf_dir))
    return alerts.high_error_alerts(
        counters, "landing", F.lit(f"{AS_OF}T00:00:00+00:00"), DEFAULT_ERROR_THRESHOLD
    )


# --- File names -------------------------------------------------------------------------

@register(
    "filename_partition",
    _sql("SELECT DISTINCT source_key, store, \"date\", CAST(NULL AS VARCHAR) AS error FROM sales_raw"),
)
def filename_partition(spark, sf_dir):
    key = F.col("source_key")
    files = sales_raw(spark, sf_dir).select("source_key").distinct()
    return files.select(
        "source_key",
        names.store_of(key).alias("store"),
        names.file_date_of(key).alias("date"),
        names.name_error(key).alias("error"),
    )


# --- Reports ----------------------------------------------------------------------------

@register("report_sample")
def report_sample(spark, sf_dir):
    return reports.sanity_sample_rows(good_data(spark, sf_dir))


@register("report_partition_rows")
def report_partition_rows(spark, sf_dir):
    return reports.single_partition_rows(good_data(spark, sf_dir), "01", AS_OF)


_SAMPLED = "SELECT least(count(*), {n}) AS rows, least(count(*), {n}) AS of_table FROM good {where}"


def _sampled(sample: DataFrame, whole: DataFrame) -> DataFrame:
    """How many rows a sample has, and how many of them the table has too."""
    # A sample is a few rows: the table is sought for them, not shuffled.
    few = F.broadcast(sample.select(*[F.col(c).alias(f"_{c}") for c in whole.columns]))
    same = [F.col(f"_{c}").eqNullSafe(F.col(c)) for c in whole.columns]
    there = whole.join(few, same, "left_semi").distinct()
    there = there.select(*[F.col(c).alias(f"_{c}") for c in whole.columns])
    found = sample.join(there, same, "left_semi")
    counted = found.agg(F.count(F.lit(1)).alias("of_table"))
    return sample.agg(F.count(F.lit(1)).alias("rows")).join(counted)


@register("report_sample_counts", _sql(_SAMPLED.format(n=20, where="")))
def report_sample_counts(spark, sf_dir):
    good = good_data(spark, sf_dir)
    return _sampled(stage(reports.sanity_sample_rows(good), "sample"), good)


@register(
    "report_partition_rows_counts",
    _sql(_SAMPLED.format(n=50, where=f"""WHERE store = '01' AND "date" = '{AS_OF}'""")),
)
def report_partition_rows_counts(spark, sf_dir):
    good = good_data(spark, sf_dir)
    sample = stage(reports.single_partition_rows(good, "01", AS_OF), "sample")
    return _sampled(sample, good.filter((F.col("store") == "01") & (F.col("date") == AS_OF)))


@register(
    "report_store_daily",
    _sql(
        f"""SELECT "date", {_MONEY} AS revenue FROM good WHERE store = '01' GROUP BY ALL ORDER BY "date" """
    ),
)
def report_store_daily(spark, sf_dir):
    return reports.store_daily_revenue(good_data(spark, sf_dir), "01")


@register(
    "report_day_store",
    _sql(
        f"""SELECT store, {_MONEY} AS revenue FROM good WHERE "date" = '{AS_OF}'
GROUP BY ALL ORDER BY revenue DESC, store"""
    ),
)
def report_day_store(spark, sf_dir):
    return reports.day_store_revenue(good_data(spark, sf_dir), AS_OF)


@register(
    "report_top_month",
    _sql(
        f"""SELECT product_id, {_MONEY} AS total_revenue FROM good
WHERE "date" BETWEEN strftime(date_trunc('month', DATE '{AS_OF}'), '%Y-%m-%d')
  AND strftime(last_day(DATE '{AS_OF}'), '%Y-%m-%d')
GROUP BY ALL ORDER BY total_revenue DESC, product_id LIMIT 10"""
    ),
)
def report_top_month(spark, sf_dir):
    return reports.top_products_month(good_data(spark, sf_dir), AS_OF)


@register(
    "report_rolling_7d",
    _sql(
        f"""SELECT "date", store, COUNT(*) AS files_processed, SUM(total_rows) AS total_rows,
  SUM(good_rows) AS good_rows, SUM(bad_rows) AS bad_rows,
  round(AVG(bad_row_rate), 4) AS avg_bad_row_rate,
  round(AVG(payment_success_rate), 4) AS avg_payment_success_rate,
  round(AVG(total_rows * 0.25 + bad_rows), 2) AS avg_duration_ms
FROM counters WHERE "date" >= strftime(DATE '{AS_OF}' - INTERVAL 7 DAY, '%Y-%m-%d')
GROUP BY "date", store ORDER BY "date" DESC, store""",
        _COUNTERS,
    ),
)
def report_rolling_7d(spark, sf_dir):
    # Wall time cannot be compared, so the duration is a function of the counters.
    duration = F.col("total_rows") * 0.25 + F.col("bad_rows")
    records = summary.file_summary(validated(spark, sf_dir), F.lit("-"), duration)
    stored = names.with_partition(records)
    found = _catalogued(
        spark, sf_dir, tables.METADATA, lambda p: sinks.write_metadata(stored, p)
    )
    return reports.rolling_7d_metadata_summary(found, AS_OF)


# --- Landing zone: files written from the order tables, then read back as uploads ------------


def _landing_zone(spark: SparkSession, sf_dir: str) -> str:
    return _kept(spark, sf_dir, "landing", lambda p: write_landing_zone(spark, sf_dir, p))


@lru_cache(maxsize=None)
def _ingested(spark: SparkSession, sf_dir: str) -> tuple[Ingested, str]:
    output = new_work_path(spark, "tables")
    found = ingest(spark, _landing_zone(spark, sf_dir), output, source_bucket="landing")
    return found, output


def _upload():
    return names.upload_name(F.col("source_key")).alias("upload")


def _landing_sql(body: str, *more: str) -> str:
    shared = [sales_raw_sql("year"), VALIDATED_SQL, OUTCOMES_SQL]
    return "WITH " + ",".join([*shared, *more]) + "\n" + body


@register("schema_verdicts", _landing_sql("SELECT upload, header_error AS error FROM uploads"))
def schema_verdicts(spark, sf_dir):
    zone = landing.Landing(_landing_zone(spark, sf_dir), dt.datetime.now(dt.timezone.utc))
    files = landing.file_verdicts(spark, zone)
    return files.groupBy(_upload()).agg(F.min("header_error").alias("error"))


@register(
    "landing_rows",
    _landing_sql(
        f"""SELECT replace(source_key, 'store_13', 'shop_13') AS upload, COUNT(*) AS rows, {", ".join(
            f"COUNT({c}) AS {c}" for c in INPUT_COLUMNS)},
  COUNT(*) FILTER (store = '15' AND l_orderkey % 11 = 0) AS overlong
FROM (SELECT * REPLACE (CASE WHEN store = '14' AND l_orderkey % 13 = 0 THEN '2024-13-45' ELSE order_date END
  AS order_date) FROM sales_raw) WHERE store NOT IN ('17', '18') GROUP BY source_key"""
    ),
)
def landing_rows(spark, sf_dir):
    """Fields found per upload, by name whatever their order in the file."""
    zone = landing.Landing(_landing_zone(spark, sf_dir), dt.datetime.now(dt.timezone.utc))
    files = landing.file_verdicts(spark, zone)
    rows = landing.raw_rows(spark, zone, files)
    readable = files.filter("header_error IS NULL").select("source_key").distinct()
    return (
        rows.join(readable, "source_key", "left_semi")
        .groupBy(_upload())
        .agg(
            F.count(F.lit(1)).alias("rows"),
            *[F.count(c).alias(c) for c in INPUT_COLUMNS],
            F.sum("overlong").alias("overlong"),
        )
    )


@register(
    "overlong_rows",
    _landing_sql("SELECT upload FROM uploads WHERE overlong > 0"),
)
def overlong_rows(spark, sf_dir):
    found, _ = _ingested(spark, sf_dir)
    return found.outcomes.filter(F.col("error") == verdicts.OVERLONG).select(_upload())


@register(
    "file_outcomes",
    _landing_sql(
        """SELECT upload, store, "date", CASE WHEN error IS NULL THEN 'success' ELSE 'error' END AS status, error,
  CASE WHEN error IS NULL THEN total_rows ELSE 0 END AS total_rows,
  CASE WHEN error IS NULL THEN good_rows ELSE 0 END AS good_rows FROM outcomes"""
    ),
)
def file_outcomes(spark, sf_dir):
    found, _ = _ingested(spark, sf_dir)
    counts = [F.coalesce(f"summary.{c}", F.lit(0)).alias(c) for c in ("total_rows", "good_rows")]
    results = found.results().select("source_key", *counts)
    return found.outcomes.join(results, "source_key").select(
        _upload(), "store", "date", "status", "error", "total_rows", "good_rows"
    )


@register(
    "failure_alerts",
    _landing_sql(
        """SELECT 'pipeline_failure' AS event_type, 'landing' AS source_bucket, upload, error
FROM outcomes WHERE error IS NOT NULL"""
    ),
)
def failure_alerts(spark, sf_dir):
    found, _ = _ingested(spark, sf_dir)
    return found.failure_alerts.select("event_type", "source_bucket", _upload(), "error")


_WRITTEN_OUTCOMES = _landing_sql(
    """SELECT upload, store, "date", CASE WHEN error IS NULL THEN 'success' ELSE 'error' END AS status,
  error FROM outcomes"""
)
_WRITTEN_ALERTS = _landing_sql(
    """SELECT 'pipeline_failure' AS event_type, upload, error, NULL::DOUBLE AS bad_row_rate
FROM outcomes WHERE error IS NOT NULL
UNION ALL SELECT 'high_error_rate', upload, NULL, bad_row_rate FROM (
  SELECT replace(source_key, 'store_13', 'shop_13') AS upload,
    round_even(COUNT(*) FILTER (validation_errors <> '') / COUNT(*), 4) AS bad_row_rate
  FROM landed JOIN accepted USING (source_key) GROUP BY ALL)
WHERE bad_row_rate >= 0.20"""
)


@register("outcomes_roundtrip", _WRITTEN_OUTCOMES)
def outcomes_roundtrip(spark, sf_dir):
    _, output = _ingested(spark, sf_dir)
    return tables.read_outcomes(spark, f"{output}/outcomes").select(
        _upload(), "store", "date", "status", "error"
    )


@register("alerts_roundtrip", _WRITTEN_ALERTS)
def alerts_roundtrip(spark, sf_dir):
    _, output = _ingested(spark, sf_dir)
    return tables.read_alerts(spark, f"{output}/alerts").select(
        "event_type", _upload(), "error", "bad_row_rate"
    )


@register(
    "sink_roundtrip",
    _landing_sql(
        f"""SELECT {_ROW}, store, "date" FROM landed JOIN accepted USING (source_key)
WHERE validation_errors = ''"""
    ),
)
def sink_roundtrip(spark, sf_dir):
    _, output = _ingested(spark, sf_dir)
    return tables.read_good_data(spark, f"{output}/processed/good_data")


@register(
    "bad_data_roundtrip",
    _landing_sql(
        f"""SELECT {_ROW}, validation_errors, store, "date" FROM landed JOIN accepted USING (source_key)
WHERE validation_errors <> ''"""
    ),
)
def bad_data_roundtrip(spark, sf_dir):
    _, output = _ingested(spark, sf_dir)
    return tables.read_bad_data(spark, f"{output}/errors")


@register(
    "metadata_roundtrip",
    _landing_sql(
        """SELECT store, "date", COUNT(*) AS total_rows,
  COUNT(*) FILTER (validation_errors = '') AS good_rows,
  COUNT(*) FILTER (validation_errors <> '') AS bad_rows,
  round_even(COUNT(*) FILTER (validation_errors <> '') / COUNT(*), 4) AS bad_row_rate,
  round_even(COUNT(*) FILTER (validation_errors = '' AND lower(payment_status) = 'paid')
    / COUNT(*) FILTER (validation_errors = ''), 4) AS payment_success_rate,
  COUNT(DISTINCT order_date) FILTER (validation_errors = '') AS days,
  COUNT(DISTINCT customer_id) FILTER (validation_errors = '') AS customers
FROM landed JOIN accepted USING (source_key) GROUP BY ALL"""
    ),
)
def metadata_roundtrip(spark, sf_dir):
    _, output = _ingested(spark, sf_dir)
    return tables.read_metadata(spark, f"{output}/metadata").select(
        "store",
        "date",
        "total_rows",
        "good_rows",
        "bad_rows",
        "bad_row_rate",
        "payment_success_rate",
        F.size("daily_revenue").alias("days"),
        F.size("orders_per_customer").alias("customers"),
    )


@register("stream_ingest", _SQL["sink_roundtrip"])
def stream_ingest(spark, sf_dir):
    """The same landing zone taken as a stream of arrivals."""
    output = new_work_path(spark, "streamed-tables")
    query = ingest_arrivals(
        spark, _landing_zone(spark, sf_dir), output, new_work_path(spark, "stream-checkpoint")
    )
    query.awaitTermination()
    return tables.read_good_data(spark, f"{output}/processed/good_data")


@register("stream_replayed", _SQL["sink_roundtrip"])
def stream_replayed(spark, sf_dir):
    """Micro-batches that are delivered twice leave the tables as one delivery does."""
    output = new_work_path(spark, "replayed-tables")
    for _ in range(2):  # A checkpoint of its own: the second stream takes all files again.
        checkpoint = new_work_path(spark, "replay-checkpoint")
        ingest_arrivals(spark, _landing_zone(spark, sf_dir), output, checkpoint).awaitTermination()
    return tables.read_good_data(spark, f"{output}/processed/good_data")


# What stands after the uploads of the first stores were sent again with odd orders only.
_CORRECTED = _landing_sql(
    f"""SELECT {_ROW}, store, "date" FROM landed JOIN accepted USING (source_key)
WHERE validation_errors = '' AND NOT (store < '{CORRECTED_BELOW}' AND CAST(order_id AS BIGINT) % 2 = 0)"""
)


@register("late_run_replaces_nothing", _CORRECTED)
def late_run_replaces_nothing(spark, sf_dir):
    """Corrections are taken first, the older uploads of the same names in a later run."""
    older = _landing_zone(spark, sf_dir)
    newer = _kept(
        spark, sf_dir, "corrections", lambda p: write_landing_zone(spark, sf_dir, p, corrected=True)
    )
    output = new_work_path(spark, "ledger-tables")
    for zone in (newer, older):
        ingest(spark, zone, output)
    return tables.read_good_data(spark, f"{output}/processed/good_data")


@register("reuploads", _CORRECTED)
def reuploads(spark, sf_dir):
    """Uploads that are sent again under their paths are news, and no others are read."""
    zone, output = new_work_path(spark, "changing-landing"), new_work_path(spark, "changed-tables")
    write_landing_zone(spark, sf_dir, zone)
    ingest_changes(spark, zone, output)
    write_landing_zone(spark, sf_dir, zone, corrected=True)
    ingest_changes(spark, zone, output)
    return tables.read_good_data(spark, f"{output}/processed/good_data")


@register(
    "missing_uploads",
    _landing_sql(
        f"""SELECT upload, CASE WHEN error IS NULL THEN 'success' ELSE 'error' END AS status, error FROM outcomes
UNION ALL SELECT 'gone_' || upload, 'error', '{verdicts.MISSING}' FROM outcomes"""
    ),
)
def missing_uploads(spark, sf_dir):
    """Named uploads, each with one beside it that is gone: the others are judged."""
    zone = _landing_zone(spark, sf_dir)
    found, _ = _ingested(spark, sf_dir)
    uploads = [row.upload for row in found.outcomes.select(_upload()).toLocalIterator()]
    named = [f"{zone}/{name}{u}" for u in uploads for name in ("upload=", "upload=gone_")]
    judged = examine(spark, named, source_bucket="landing")
    return judged.outcomes.select(_upload(), "status", "error")


@register(
    "partition_discovery",
    _landing_sql(
        """SELECT store, "date", COUNT(*) AS rows FROM landed JOIN accepted USING (source_key)
WHERE validation_errors = '' GROUP BY ALL"""
    ),
)
def partition_discovery(spark, sf_dir):
    """The partitions that the catalogue knows by the ledger, no folder looked for."""
    _, output = _ingested(spark, sf_dir)
    name = tables.synced(spark, output, tables.GOOD_DATA)
    part = F.col("partition")
    known = spark.sql(f"SHOW PARTITIONS {name}").select(
        F.regexp_extract(part, "store=([^/]*)", 1).alias("store"),
        F.regexp_extract(part, "date=([^/]*)", 1).alias("date"),
    )
    rows = spark.table(name).groupBy("store", "date").agg(F.count(F.lit(1)).alias("rows"))
    return known.join(rows, ["store", "date"], "left")


@register(
    "latest_file_wins",
    """WITH uploads AS (
  SELECT l_suppkey % 20 AS store_no, date_trunc('month', l_shipdate) AS month,
    l_linenumber % 3 AS folder, max(l_shipdate) AS modified_at
  FROM lineitem GROUP BY ALL
)
SELECT lpad(CAST(store_no AS VARCHAR), 2, '0') AS store, strftime(month, '%Y-%m-%d') AS "date",
  folder || '/store_' || lpad(CAST(store_no AS VARCHAR), 2, '0') || '_' || strftime(month, '%Y%m%d') || '.csv' AS source_key
FROM (SELECT *, row_number() OVER (PARTITION BY store_no, month ORDER BY modified_at DESC, folder DESC) AS n
  FROM uploads) WHERE n = 1""",
)
def latest_file_wins(spark, sf_dir):
    """Three folders hold an upload of each store and month; the latest line item dates it."""
    lines = table(spark, sf_dir, "lineitem")
    store = F.lpad((F.col("l_suppkey") % 20).cast("string"), 2, "0")
    month = F.trunc("l_shipdate", "MONTH").cast("string")
    day = F.replace(month, F.lit("-"))
    folder = (F.col("l_linenumber") % 3).cast("string")
    key = F.concat(folder, F.lit("/store_"), store, F.lit("_"), day, F.lit(".csv"))
    uploads = lines.groupBy(key.alias("source_key")).agg(F.max("l_shipdate").alias("modified_at"))
    placed = uploads.select(
        "source_key",
        "modified_at",
        names.store_of(F.col("source_key")).alias("store"),
        names.file_date_of(F.col("source_key")).alias("date"),
    )
    return verdicts.latest_uploads(placed)


# --- Report batch and manifest ---------------------------------------------------------------


@register(
    "report_batch",
    _landing_sql(
        f"""SELECT query_name, '{BATCH_DAY}' AS run_date, rows FROM (
  SELECT 'sanity_sample_rows' AS query_name, least(COUNT(*), 20) AS rows FROM sold
  UNION ALL SELECT 'single_partition_rows', least(COUNT(*), 50) FROM sold WHERE store = '01' AND "date" = '{BATCH_DAY}'
  UNION ALL SELECT 'store_daily_revenue', COUNT(DISTINCT "date") FROM sold WHERE store = '01'
  UNION ALL SELECT 'day_store_revenue', COUNT(DISTINCT store) FROM sold WHERE "date" = '{BATCH_DAY}'
  UNION ALL SELECT 'top_products_month', least(COUNT(DISTINCT product_id), 10) FROM sold WHERE "date" = '{BATCH_DAY}'
  UNION ALL SELECT 'rolling_7d_metadata_summary', COUNT(DISTINCT (store, "date")) FROM landed JOIN accepted USING (source_key)
    WHERE "date" >= '{BATCH_DAY}'
)""",
        "sold AS (SELECT landed.* FROM landed JOIN accepted USING (source_key) WHERE validation_errors = '')",
    ),
)
def report_batch(spark, sf_dir):
    _, output = _ingested(spark, sf_dir)
    runs = run_reports(
        spark,
        tables.read_good_data(spark, f"{output}/processed/good_data"),
        tables.read_metadata(spark, f"{output}/metadata"),
        new_work_path(spark, "results"),
        run_date=BATCH_DAY,
        as_of=BATCH_DAY,
    )
    return runs.select("query_name", "run_date", "rows")


@register(
    "result_manifest",
    _landing_sql(
        """SELECT DISTINCT 'athena_query_result_created' AS event_type, store, "date", true AS has_rows
FROM landed JOIN accepted USING (source_key) WHERE validation_errors <> ''"""
    ),
)
def result_manifest(spark, sf_dir):
    """Records of the error files, which are CSVs, among all files of the run."""
    _, output = _ingested(spark, sf_dir)
    records = manifest.result_manifest(spark, output)
    return records.select(
        "event_type",
        F.regexp_extract("key", r"/store=([^/]*)/", 1).alias("store"),
        F.regexp_extract("key", r"/date=([^/]*)/", 1).alias("date"),
        (F.col("size_bytes") > 0).alias("has_rows"),
    ).distinct()


@register(
    "manifest_told_once",
    _landing_sql(
        """SELECT DISTINCT 1 AS run, store, "date", true AS has_rows
FROM landed JOIN accepted USING (source_key) WHERE validation_errors <> ''"""
    ),
)
def manifest_told_once(spark, sf_dir):
    """New error files, asked for twice: the second run has nothing to tell."""
    _, output = _ingested(spark, sf_dir)
    told = new_work_path(spark, "told-results")
    runs = [
        manifest.new_results(spark, output, told).withColumn("run", F.lit(n)) for n in (1, 2)
    ]
    return runs[0].unionByName(runs[1]).select(
        "run",
        F.regexp_extract("key", r"/store=([^/]*)/", 1).alias("store"),
        F.regexp_extract("key", r"/date=([^/]*)/", 1).alias("date"),
        (F.col("size_bytes") > 0).alias("has_rows"),
    ).distinct()


# --- Health ------------------------------------------------------------------------------------


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("ts").cast("timestamp").alias("ts"), "event_type", "value"
    )


_ERRORS_SQL = """SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS period_start,
  time_bucket(INTERVAL 5 MINUTE, ts) + INTERVAL 5 MINUTE AS period_end, COUNT(*) AS errors
FROM events WHERE event_type = 'error' GROUP BY ALL"""


@register("error_periods_5m", _ERRORS_SQL)
def error_periods_5m(spark, sf_dir):
    return health.errors_per_period(_events(spark, sf_dir), "ts", F.col("event_type") == "error")


@register("error_alarm_5m", _ERRORS_SQL + " HAVING COUNT(*) >= 3")
def error_alarm_5m(spark, sf_dir):
    return health.error_alarms(_events(spark, sf_dir), "ts", F.col("event_type") == "error")


_PERIODS_SQL = """periods AS (
  SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS period_start,
    time_bucket(INTERVAL 5 MINUTE, ts) + INTERVAL 5 MINUTE AS period_end,
    COUNT(value) AS runs, quantile_disc(value, 0.99) AS p99_ms
  FROM events GROUP BY ALL
)"""

# Event values stand in for durations; the threshold is scaled to them.
EVENT_LATENCY_THRESHOLD = 60.0


@register(
    "latency_periods_5m",
    f"WITH {_PERIODS_SQL} SELECT *, p99_ms >= {EVENT_LATENCY_THRESHOLD} AS breaching FROM periods",
)
def latency_periods_5m(spark, sf_dir):
    return health.latency_periods(_events(spark, sf_dir), "ts", "value", EVENT_LATENCY_THRESHOLD)


@register(
    "latency_periods_yearly",
    """SELECT period_start, period_start + INTERVAL 365 DAY AS period_end,
  COUNT(l_extendedprice) AS runs, quantile_disc(l_extendedprice::DOUBLE, 0.99) AS p99_ms,
  quantile_disc(l_extendedprice::DOUBLE, 0.99) >= 60000 AS breaching
FROM (SELECT *, time_bucket(INTERVAL 365 DAY, l_shipdate::TIMESTAMP, TIMESTAMP '1970-01-01') AS period_start
      FROM lineitem) GROUP BY ALL""",
)
def latency_periods_yearly(spark, sf_dir):
    """Periods of very many runs: line items by ship date, prices as durations."""
    items = table(spark, sf_dir, "lineitem").select(
        F.col("l_shipdate").cast("timestamp").alias("ts"), F.col("l_extendedprice").cast("double")
    )
    return health.latency_periods(items, "ts", "l_extendedprice", 60_000.0, "365 days")


@register(
    "p99_alarm_5m",
    f"""WITH {_PERIODS_SQL}, breaching AS (SELECT * FROM periods WHERE p99_ms >= {EVENT_LATENCY_THRESHOLD})
SELECT b.* FROM breaching b JOIN breaching before ON before.period_end = b.period_start""",
)
def p99_alarm_5m(spark, sf_dir):
    return health.latency_alarms(_events(spark, sf_dir), "ts", "value", EVENT_LATENCY_THRESHOLD)


@register(
    "stream_error_alarm_5m",
    f"""SELECT period_start, period_end, errors FROM ({_ERRORS_SQL}) WHERE errors >= 2
AND period_end <= (SELECT max(ts) FROM events) - INTERVAL 5 MINUTE""",
)
def stream_error_alarm_5m(spark, sf_dir):
    """Events as a stream, two errors a period; periods the watermark has closed."""
    schema = table(spark, sf_dir, "events").schema
    events = (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", "events.parquet")
        .parquet(sf_dir)
        .select(F.col("ts").cast("timestamp").alias("ts"), "event_type")
    )
    # The watermark follows all events, not only errors.
    alarms = streaming_error_alarms(events, "ts", F.col("event_type") == "error", threshold=2)
    return _streamed(spark, alarms)


def _streamed(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """What a stream appends until its source has nothing more."""
    path = new_work_path(spark, "alarms")
    query = (
        rows.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", new_work_path(spark, "alarm-checkpoint"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(rows.schema).parquet(path)


@register(
    "stream_p99_alarm_5m",
    f"""WITH {_PERIODS_SQL}, breaching AS (SELECT * FROM periods WHERE p99_ms >= {EVENT_LATENCY_THRESHOLD})
SELECT b.period_start, b.period_end, b.runs FROM breaching b JOIN breaching before
  ON before.period_end = b.period_start
WHERE b.period_end <= (SELECT max(ts) FROM events) - INTERVAL 5 MINUTE""",
)
def stream_p99_alarm_5m(spark, sf_dir):
    """The latency alarm of events as a stream; periods the watermark has closed."""
    events = (
        spark.readStream.schema(table(spark, sf_dir, "events").schema)
        .option("pathGlobFilter", "events.parquet")
        .parquet(sf_dir)
        .select(F.col("ts").cast("timestamp").alias("ts"), "value")
    )
    alarms = streaming_latency_alarms(events, "ts", "value", EVENT_LATENCY_THRESHOLD)
    return _streamed(spark, alarms).select("period_start", "period_end", "runs")


@register(
    "failure_alarm",
    _landing_sql(
        "SELECT COUNT(*) AS errors FROM outcomes WHERE error IS NOT NULL HAVING COUNT(*) >= 3"
    ),
)
def failure_alarm(spark, sf_dir):
    """The error alarm over the failed uploads of the ingest job's own runs, as a stream."""
    _, output = _ingested(spark, sf_dir)
    events = failure_events(spark, output)
    alarms = health.error_alarms(events, "ts", F.col("status") == "error")
    path = new_work_path(spark, "failure-alarms")

    # One row per period with errors; a run's periods may grow, so all are written anew.
    def write(periods: DataFrame, _: int) -> None:
        periods.write.mode("overwrite").parquet(path)

    query = (
        alarms.writeStream.outputMode("complete")
        .foreachBatch(write)
        .option("checkpointLocation", new_work_path(spark, "failure-checkpoint"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(alarms.schema).parquet(path).select("errors")
