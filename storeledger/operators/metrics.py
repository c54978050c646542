"""Metrics over good rows, per file or over a whole table.

`keys` names the grouping (default: the file). Every aggregate is partial before
its shuffle; the top list is cut to ten per task before its shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storeledger.contract import SUCCESS_STATUS, TOP_PRODUCTS
from storeledger.functions import iso_day, product_sum, python_round, with_products
from storeledger.operators.validate import is_good

FILE = ("source_key",)


def _revenue_by(rows: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Sum of quantity * unit_price by keys."""
    priced = with_products(rows.select(*keys, "quantity", "unit_price"), "quantity", "unit_price")
    return priced.groupBy(*keys).agg(product_sum().alias(name))


def _is_paid() -> Column:
    return F.lower("payment_status") == SUCCESS_STATUS


def _rate(part: Column, whole: Column) -> Column:
    """part / whole to four places; 0.0 of nothing."""
    return F.when(whole > 0, python_round(part / whole, 4)).otherwise(F.lit(0.0))


def daily_revenue(good: DataFrame, keys: tuple[str, ...] = FILE) -> DataFrame:
    """Revenue per order date, all payment states included."""
    dated = good.select(*keys, "order_date", "quantity", "unit_price").withColumn(
        "order_date", iso_day(F.col("order_date"))
    )
    return _revenue_by(dated, [*keys, "order_date"], "daily_revenue")


def product_revenue(good: DataFrame, keys: tuple[str, ...] = FILE) -> DataFrame:
    return _revenue_by(good, [*keys, "product_id"], "total_revenue")


def top_products(
    good: DataFrame, keys: tuple[str, ...] = FILE, n: int = TOP_PRODUCTS
) -> DataFrame:
    """The n products with the highest revenue; ties go to the smaller id."""
    totals = product_revenue(good, keys)
    order = [F.desc("total_revenue"), F.asc("product_id")]
    if not keys:
        return totals.orderBy(*order).limit(n)
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return totals.withColumn("rank", rank).filter(F.col("rank") <= n)


def orders_per_customer(good: DataFrame, keys: tuple[str, ...] = FILE) -> DataFrame:
    """Distinct orders per customer."""
    return good.groupBy(*keys, "customer_id").agg(
        F.count_distinct("order_id").alias("order_count")
    )


def payment_success_rate(good: DataFrame, keys: tuple[str, ...] = FILE) -> DataFrame:
    """Share of good rows that are paid."""
    return good.groupBy(*keys).agg(
        _rate(F.count_if(_is_paid()), F.count(F.lit(1))).alias("payment_success_rate")
    )


def row_counters(validated: DataFrame, keys: tuple[str, ...] = FILE) -> DataFrame:
    """Row counts, bad-row rate and payment rate in one pass over validated rows."""
    counted = validated.groupBy(*keys).agg(
        F.sum("copies").alias("total_rows"),
        F.count_if(is_good()).alias("good_rows"),
        F.count_if(is_good() & _is_paid()).alias("paid_rows"),
    )
    return with_rates(counted)


def with_rates(counted: DataFrame) -> DataFrame:
    """Add bad_rows and the two rates to total, good and paid counts."""
    total, good = F.col("total_rows"), F.col("good_rows")
    keys = [c for c in counted.columns if c not in ("total_rows", "good_rows", "paid_rows")]
    return counted.select(
        *keys,
        "total_rows",
        "good_rows",
        (total - good).alias("bad_rows"),
        _rate(total - good, total).alias("bad_row_rate"),
        _rate(F.col("paid_rows"), good).alias("payment_success_rate"),
    )


def overall_metrics(validated: DataFrame) -> DataFrame:
    """One row over all files: counters, rates and revenue."""
    sold = validated.select(
        "copies",
        "error_mask",
        "payment_status",
        *[F.when(is_good(), F.col(c)).alias(c) for c in ("quantity", "unit_price")],
    )
    totals = with_products(sold, "quantity", "unit_price").agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("total_rows"),
        F.count_if(is_good()).alias("good_rows"),
        F.count_if(is_good() & _is_paid()).alias("paid_rows"),
        F.coalesce(product_sum(), F.lit(0.0)).alias("revenue"),
    )
    return with_rates(totals)
