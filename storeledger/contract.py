"""The data contract: columns, table schemas and rule names.

Everything in this module is a fixed value that readers of the tables rely on.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- Fixed values: the raw file ------------------------------------------------

# A store file holds exactly these columns, in any order.
INPUT_COLUMNS = (
    "order_id",
    "customer_id",
    "product_id",
    "order_date",
    "quantity",
    "unit_price",
    "payment_status",
)

# Columns that must hold text, in the order their rules report.
REQUIRED_TEXT_COLUMNS = (
    "order_id",
    "customer_id",
    "product_id",
    "order_date",
    "payment_status",
)

PAYMENT_STATUSES = ("paid", "pending", "failed")
SUCCESS_STATUS = "paid"

# store_<digits>_<YYYYMMDD>.csv; the date is not checked against a calendar.
FILE_NAME_PATTERN = r"^store_(\d+)_(\d{4})(\d{2})(\d{2})\.csv$"

# Field texts read as null, as pandas does by default.
NA_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)

# The characters Python's str.strip() removes.
PYTHON_WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Calendar dates a nanosecond timestamp can hold.
MIN_ORDER_DATE = "1677-09-22"
MAX_ORDER_DATE = "2262-04-11"

# --- Fixed values: row rules, in report order ------------------------------------

DUPLICATE_ROW = "duplicate_row"
ERROR_CODES = (
    "duplicate_row",
    "missing_order_id",
    "missing_customer_id",
    "missing_product_id",
    "missing_order_date",
    "missing_payment_status",
    "missing_quantity",
    "non_positive_quantity",
    "missing_unit_price",
    "non_positive_unit_price",
    "invalid_payment_status",
)

# --- Fixed values: alerts, results, health ---------------------------------------

DEFAULT_ERROR_THRESHOLD = 0.20
HIGH_ERROR_EVENT = "high_error_rate"
FAILURE_EVENT = "pipeline_failure"
RESULT_EVENT = "athena_query_result_created"

TOP_PRODUCTS = 10
ALARM_PERIOD = "5 minutes"
ERROR_ALARM_COUNT = 3
LATENCY_ALARM_MS = 240_000
LATENCY_ALARM_PERIODS = 2

# --- Fixed values: output layout --------------------------------------------------

GOOD_DATA_PATH = "processed/good_data"
BAD_DATA_PATH = "errors"
METADATA_PATH = "metadata"
CUSTOMER_ORDERS_PATH = "customer_orders"
OUTCOMES_PATH = "outcomes"
ALERTS_PATH = "alerts"

# --- Fixed values: schemas ----------------------------------------------------------------------

PARTITION_COLUMNS = ("store", "date")

_PARTITION_FIELDS = [T.StructField(c, T.StringType()) for c in PARTITION_COLUMNS]


def _typed_fields() -> list[T.StructField]:
    numeric = {"quantity", "unit_price"}
    return [
        T.StructField(c, T.DoubleType() if c in numeric else T.StringType())
        for c in INPUT_COLUMNS
    ]


GOOD_DATA_SCHEMA = T.StructType(_typed_fields() + _PARTITION_FIELDS)

BAD_DATA_SCHEMA = T.StructType(
    _typed_fields()
    + [T.StructField("validation_errors", T.StringType())]
    + _PARTITION_FIELDS
)

DAILY_REVENUE_TYPE = T.ArrayType(
    T.StructType(
        [
            T.StructField("order_date", T.StringType()),
            T.StructField("daily_revenue", T.DoubleType()),
        ]
    )
)
TOP_PRODUCTS_TYPE = T.ArrayType(
    T.StructType(
        [
            T.StructField("product_id", T.StringType()),
            T.StructField("total_revenue", T.DoubleType()),
        ]
    )
)
ORDERS_PER_CUSTOMER_TYPE = T.ArrayType(
    T.StructType(
        [
            T.StructField("customer_id", T.StringType()),
            T.StructField("order_count", T.LongType()),
        ]
    )
)

SUMMARY_FIELDS = [
    T.StructField("source_key", T.StringType()),
    T.StructField("processed_at", T.StringType()),
    T.StructField("total_rows", T.LongType()),
    T.StructField("good_rows", T.LongType()),
    T.StructField("bad_rows", T.LongType()),
    T.StructField("bad_row_rate", T.DoubleType()),
    T.StructField("payment_success_rate", T.DoubleType()),
    T.StructField("daily_revenue", DAILY_REVENUE_TYPE),
    T.StructField("top_products", TOP_PRODUCTS_TYPE),
    T.StructField("orders_per_customer", ORDERS_PER_CUSTOMER_TYPE),
    T.StructField("duration_ms", T.DoubleType()),
]

# Customers of a file are rows of a table of their own, however many there are; reading
# the metadata puts each file's list back into its record.
STORED_SUMMARY_FIELDS = [f for f in SUMMARY_FIELDS if f.name != "orders_per_customer"]
METADATA_SCHEMA = T.StructType(STORED_SUMMARY_FIELDS + _PARTITION_FIELDS)
CUSTOMER_ORDERS_SCHEMA = T.StructType(
    [
        T.StructField("source_key", T.StringType()),
        T.StructField("customer_id", T.StringType()),
        T.StructField("order_count", T.LongType()),
    ]
    + _PARTITION_FIELDS
)

# What each committed run took: its uploads, and the files they were read from.
LEDGER_SCHEMA = T.StructType(
    [
        T.StructField("source_key", T.StringType()),
        *_PARTITION_FIELDS,
        T.StructField("modified_at", T.TimestampType()),
        T.StructField("status", T.StringType()),
        T.StructField("good_rows", T.LongType()),
        T.StructField("bad_rows", T.LongType()),
        T.StructField("committed_at", T.TimestampType()),
        T.StructField("version", T.StringType()),
    ]
)
TAKEN_FILES_SCHEMA = T.StructType(
    [
        T.StructField("file_path", T.StringType()),
        T.StructField("source_key", T.StringType()),
        T.StructField("modified_at", T.TimestampType()),
        T.StructField("length", T.LongType()),
        T.StructField("version", T.StringType()),
    ]
)

# Outcomes and alerts of each run, in a folder per run.
OUTCOMES_SCHEMA = T.StructType(
    [
        T.StructField("source_key", T.StringType()),
        *_PARTITION_FIELDS,
        T.StructField("modified_at", T.TimestampType()),
        T.StructField("status", T.StringType()),
        T.StructField("error", T.StringType()),
        T.StructField("run_id", T.StringType()),
    ]
)
ALERTS_SCHEMA = T.StructType(
    [
        T.StructField("event_type", T.StringType()),
        T.StructField("source_bucket", T.StringType()),
        T.StructField("source_key", T.StringType()),
        T.StructField("bad_row_rate", T.DoubleType()),
        T.StructField("threshold", T.DoubleType()),
        T.StructField("bad_rows", T.LongType()),
        T.StructField("total_rows", T.LongType()),
        T.StructField("error", T.StringType()),
        T.StructField("occurred_at", T.StringType()),
        T.StructField("run_id", T.StringType()),
    ]
)
