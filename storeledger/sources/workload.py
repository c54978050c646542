"""A store-sales workload derived from order tables.

Line items become rows of daily store files. A fixed share of rows is made to
break each rule, keyed on the order number, so that any engine derives the same
rows. One file is one store and one month, or one year for the
landing zone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from storeledger.plans.staging import stage


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _every(n: int) -> Column:
    return F.col("l_orderkey") % n == 0


def _narrowed(name: str, kind: str) -> list[Column]:
    """A column as another type, and as it was where it can't be cast."""
    cast = F.col(name).try_cast(kind)
    return [cast.alias(f"{name}_cast"), F.when(cast.isNull(), F.col(name)).alias(name)]


def _whole(name: str, kind: str) -> Column:
    """A `_narrowed` column cast; a value that can't be cast fails here, if it is asked for."""
    return F.coalesce(F.col(f"{name}_cast"), F.col(name).cast(kind))


def sales_rows(spark: SparkSession, sf_dir: str, period: str = "MONTH") -> DataFrame:
    """The seven text columns, `store`, `date` and `source_key`, plus `l_orderkey`."""
    # What the rows need of a column is taken before the join, whose shuffle it makes shorter.
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        (F.col("l_suppkey") % 20).alias("store_no"),
        *_narrowed("l_quantity", "bigint"),
        *_narrowed("l_extendedprice", "decimal(18,2)"),
        F.trunc("l_shipdate", period).alias("file_day"),
    )
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", F.col("o_orderdate").cast("date"), "o_orderstatus"
    )
    # Both tables grow with the data. The shuffle also spreads the row rules over all tasks,
    # where the scan of a file with few row groups has few.
    joined = lines.join(orders.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"))

    status = (
        F.when(F.col("o_orderstatus") == "F", "paid")
        .when(F.col("o_orderstatus") == "O", "pending")
        .otherwise("failed")
    )
    rows = joined.select(
        "l_orderkey",
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.when(_every(83), " ").otherwise(F.col("o_custkey").cast("string")).alias("customer_id"),
        F.col("l_partkey").cast("string").alias("product_id"),
        F.when(~_every(89), F.col("o_orderdate").cast("string")).alias("order_date"),
        F.when(_every(53), F.lit(None))
        .when(_every(59), "0")
        .when(_every(61), "-1")
        .when(_every(67), "abc")
        .otherwise(_whole("l_quantity", "bigint").cast("string"))
        .alias("quantity"),
        F.when(_every(71), F.lit(None))
        .when(_every(73), "-5.00")
        .otherwise(_whole("l_extendedprice", "decimal(18,2)").cast("string"))
        .alias("unit_price"),
        F.when(_every(101), F.lit(None))
        .when(_every(79), "refunded")
        .when(_every(5), F.upper(status))
        .otherwise(status)
        .alias("payment_status"),
        F.lpad(F.col("store_no").cast("string"), 2, "0").alias("store"),
        F.col("file_day").cast("string").alias("date"),
    )
    # The repeated rows come from the same scan and join, not from a second one.
    copies = F.when(_every(97), F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    rows = rows.withColumn("_copy", F.explode(copies)).drop("_copy")
    return rows.withColumn(
        "source_key",
        F.concat(F.lit("store_"), "store", F.lit("_"), F.replace("date", F.lit("-")), F.lit(".csv")),
    )


def sales_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales_rows(spark, sf_dir).drop("l_orderkey")


# The same rows as SQL over the order tables.
_SALES_RAW_SQL = """
sales_rows AS (
  SELECT l.l_orderkey,
    CAST(o.o_orderkey AS VARCHAR) AS order_id,
    CASE WHEN l.l_orderkey % 83 = 0 THEN ' ' ELSE CAST(o.o_custkey AS VARCHAR) END AS customer_id,
    CAST(l.l_partkey AS VARCHAR) AS product_id,
    CASE WHEN l.l_orderkey % 89 = 0 THEN NULL ELSE strftime(o.o_orderdate, '%Y-%m-%d') END AS order_date,
    CASE WHEN l.l_orderkey % 53 = 0 THEN NULL
         WHEN l.l_orderkey % 59 = 0 THEN '0'
         WHEN l.l_orderkey % 61 = 0 THEN '-1'
         WHEN l.l_orderkey % 67 = 0 THEN 'abc'
         ELSE CAST(CAST(l.l_quantity AS BIGINT) AS VARCHAR) END AS quantity,
    CASE WHEN l.l_orderkey % 71 = 0 THEN NULL
         WHEN l.l_orderkey % 73 = 0 THEN '-5.00'
         ELSE CAST(CAST(l.l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) END AS unit_price,
    CASE WHEN l.l_orderkey % 101 = 0 THEN NULL
         WHEN l.l_orderkey % 79 = 0 THEN 'refunded'
         WHEN l.l_orderkey % 5 = 0 THEN upper(CASE o.o_orderstatus WHEN 'F' THEN 'paid' WHEN 'O' THEN 'pending' ELSE 'failed' END)
         ELSE CASE o.o_orderstatus WHEN 'F' THEN 'paid' WHEN 'O' THEN 'pending' ELSE 'failed' END END AS payment_status,
    lpad(CAST(l.l_suppkey % 20 AS VARCHAR), 2, '0') AS store,
    strftime(date_trunc('{period}', l.l_shipdate), '%Y-%m-%d') AS "date",
    'store_' || lpad(CAST(l.l_suppkey % 20 AS VARCHAR), 2, '0') || '_'
      || strftime(date_trunc('{period}', l.l_shipdate), '%Y%m%d') || '.csv' AS source_key
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
),
sales_raw AS (
  SELECT * FROM sales_rows
  UNION ALL
  SELECT * FROM sales_rows WHERE l_orderkey % 97 = 0
)"""


def sales_raw_sql(period: str = "month") -> str:
    return _SALES_RAW_SQL.replace("{period}", period)


# Row rules, one row per input row; the copy number stands for file order.
VALIDATED_SQL = """
numbered AS (
  SELECT *, row_number() OVER (
    PARTITION BY source_key, order_id, customer_id, product_id, order_date, quantity, unit_price, payment_status
    ORDER BY l_orderkey) AS copy_no
  FROM sales_raw
),
coerced AS (
  SELECT source_key, store, "date", order_id, customer_id, product_id, order_date,
    TRY_CAST(quantity AS DOUBLE) AS quantity,
    TRY_CAST(unit_price AS DOUBLE) AS unit_price,
    TRY_CAST(quantity AS DECIMAL(18,2)) * TRY_CAST(unit_price AS DECIMAL(18,2)) AS exact_revenue,
    payment_status, copy_no
  FROM numbered
),
flagged AS (
  SELECT *,
    CASE WHEN copy_no > 1 THEN 'duplicate_row' END AS e_duplicate,
    CASE WHEN order_id IS NULL OR trim(order_id) = '' THEN 'missing_order_id' END AS e_order,
    CASE WHEN customer_id IS NULL OR trim(customer_id) = '' THEN 'missing_customer_id' END AS e_customer,
    CASE WHEN product_id IS NULL OR trim(product_id) = '' THEN 'missing_product_id' END AS e_product,
    CASE WHEN order_date IS NULL OR trim(order_date) = '' THEN 'missing_order_date' END AS e_date,
    CASE WHEN payment_status IS NULL OR trim(payment_status) = '' THEN 'missing_payment_status' END AS e_status,
    CASE WHEN quantity IS NULL THEN 'missing_quantity' END AS e_qty_missing,
    CASE WHEN quantity <= 0 THEN 'non_positive_quantity' END AS e_qty_sign,
    CASE WHEN unit_price IS NULL THEN 'missing_unit_price' END AS e_price_missing,
    CASE WHEN unit_price <= 0 THEN 'non_positive_unit_price' END AS e_price_sign,
    CASE WHEN coalesce(lower(payment_status) IN ('paid', 'pending', 'failed'), false) THEN NULL
         ELSE 'invalid_payment_status' END AS e_status_value
  FROM coerced
),
validated AS (
  SELECT source_key, store, "date", order_id, customer_id, product_id, order_date,
    quantity, unit_price, exact_revenue, payment_status,
    concat_ws(';', e_duplicate, e_order, e_customer, e_product, e_date, e_status,
      e_qty_missing, e_qty_sign, e_price_missing, e_price_sign, e_status_value) AS validation_errors
  FROM flagged
),
good AS (SELECT * FROM validated WHERE validation_errors = ''),
bad AS (SELECT * FROM validated WHERE validation_errors <> '')"""


# --- A landing zone of CSV uploads derived from the same rows -----------------------------

_CANONICAL = ("order_id", "customer_id", "product_id", "order_date", "quantity", "unit_price", "payment_status")
_REORDERED = ("payment_status", "unit_price", "quantity", "order_date", "product_id", "customer_id", "order_id")
_WITHOUT_PRICE = tuple(c for c in _CANONICAL if c != "unit_price")
_WITH_EXTRAS = (*_CANONICAL, "store_id", "promo_code")

# Stores whose files carry another header; all others use the canonical one.
HEADER_OF_STORE = {"16": _REORDERED, "17": _WITHOUT_PRICE, "18": _WITH_EXTRAS}
WRONG_NAME_STORE = "13"
BAD_DATE_STORE = "14"
OVERLONG_STORE = "15"
# Stores before this one send corrections: their uploads with odd order numbers only.
CORRECTED_BELOW = "05"


def write_landing_zone(
    spark: SparkSession, sf_dir: str, root: str, corrected: bool = False
) -> None:
    """Uploads as `root/upload=<file name>/part-*.csv`, some of them faulty.

    Store 13 has a wrong file name, 14 unreadable dates, 15 overlong rows, 16 a
    reordered header, 17 a missing column and 18 two extra ones. `corrected`: only the
    corrections, which replace uploads of the same names.
    """
    wrong_name = F.replace("source_key", F.lit("store_"), F.lit("shop_"))
    bad_date = (F.col("store") == BAD_DATE_STORE) & _every(13)
    rows = sales_rows(spark, sf_dir, "YEAR").select(
        "l_orderkey",
        *[c for c in _CANONICAL if c != "order_date"],
        F.when(bad_date, "2024-13-45").otherwise(F.col("order_date")).alias("order_date"),
        F.col("store").alias("store_id"),
        F.lit("none").alias("promo_code"),
        "store",
        F.when(F.col("store") == WRONG_NAME_STORE, wrong_name)
        .otherwise(F.col("source_key"))
        .alias("upload"),
    )
    if corrected:
        odd = rows.filter((F.col("store") < CORRECTED_BELOW) & (F.col("l_orderkey") % 2 == 1))
        _write_uploads(stage(odd, "corrections"), _CANONICAL, root, replace=True)
        return
    # Most rows are written as they are joined. Those of the other headers, a few stores, are
    # staged, since each header has a write of its own.
    special = F.col("store").isin(*HEADER_OF_STORE)
    _write_uploads(rows.filter(~special), _CANONICAL, root)
    others = stage(rows.filter(special), "landing-rows")
    for store, header in HEADER_OF_STORE.items():
        _write_uploads(others.filter(F.col("store") == store), header, root)


def _write_uploads(
    rows: DataFrame, header: tuple[str, ...], root: str, replace: bool = False
) -> None:
    # No field holds a comma or quote, so a joined line is plain CSV. The header
    # line is the name of the only column.
    line = F.concat_ws(",", *[F.coalesce(F.col(c), F.lit("")) for c in header])
    overlong = (F.col("store") == OVERLONG_STORE) & _every(11)
    line = F.when(overlong, F.concat(line, F.lit(",extra"))).otherwise(line)
    (
        rows.select(line.alias(",".join(header)), "upload")
        .hint("rebalance", "upload")
        .write.mode("overwrite" if replace else "append")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("upload")
        .option("header", True)
        .option("sep", "\x01")
        .option("quote", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(root)
    )


# Expected rows and outcome of every upload. In store 14 an unreadable date stands
# where a date, or none, stood before.
OUTCOMES_SQL = """
landed AS (
  SELECT * REPLACE (
    CASE WHEN store = '14' AND CAST(order_id AS BIGINT) % 13 = 0 THEN '2024-13-45' ELSE order_date END AS order_date,
    CASE WHEN store = '14' AND CAST(order_id AS BIGINT) % 13 = 0
      THEN trim(replace(';' || validation_errors || ';', ';missing_order_date;', ';'), ';')
      ELSE validation_errors END AS validation_errors)
  FROM validated
),
uploads AS (
  SELECT source_key,
    CASE WHEN store = '13' THEN replace(source_key, 'store_', 'shop_') ELSE source_key END AS upload,
    store AS home, any_value("date") AS "date",
    COUNT(*) AS total_rows,
    COUNT(*) FILTER (validation_errors = '') AS good_rows,
    COUNT(*) FILTER (validation_errors = '' AND order_date = '2024-13-45') AS bad_dates,
    COUNT(*) FILTER (store = '15' AND CAST(order_id AS BIGINT) % 11 = 0) AS overlong,
    CASE store
      WHEN '17' THEN 'Schema validation failed: ["Missing columns: [''unit_price'']"]'
      WHEN '18' THEN 'Schema validation failed: ["Extra columns not allowed: [''promo_code'', ''store_id'']"]'
    END AS header_error
  FROM landed GROUP BY source_key, store
),
outcomes AS (
  SELECT source_key, upload,
    CASE WHEN home <> '13' THEN home END AS store,
    CASE WHEN home <> '13' THEN "date" END AS "date",
    total_rows, good_rows,
    CASE WHEN overlong > 0 THEN 'Row with more fields than the header'
         WHEN header_error IS NOT NULL THEN header_error
         WHEN bad_dates > 0 THEN 'order_date cannot be read as a date in ' || bad_dates || ' good row(s)'
         WHEN home = '13' THEN 'Filename does not match store_{id}_{YYYYMMDD}.csv: ''' || upload || ''''
    END AS error
  FROM uploads
),
accepted AS (SELECT source_key FROM outcomes WHERE error IS NULL)"""
