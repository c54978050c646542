"""The per-file summary record: counters, two short lists, and the customers' orders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storeledger.contract import (
    DAILY_REVENUE_TYPE,
    ORDERS_PER_CUSTOMER_TYPE,
    SUMMARY_FIELDS,
    TOP_PRODUCTS_TYPE,
)
from storeledger.functions import python_round
from storeledger.operators import metrics
from storeledger.operators.validate import good_rows

# Blocks that a file's list of customers is gathered by.
LIST_BLOCKS = 256


def customer_orders(validated: DataFrame) -> DataFrame:
    """source_key, customer_id, order_count: a row per customer of each file."""
    return metrics.orders_per_customer(good_rows(validated))


def file_summary(
    validated: DataFrame,
    processed_at: Column,
    duration_ms: Column,
    files: DataFrame | None = None,
) -> DataFrame:
    """One record per file, with the fields of the metadata table but orders_per_customer.

    `files` (column `source_key`) adds files that have no rows at all. Days and
    top products per file are few (bounded by the calendar and by ten); customers
    are not, so they stay rows, see `customer_orders` and `with_customers`.
    """
    good = good_rows(validated)
    counters = metrics.row_counters(validated)
    if files is not None:
        counters = files.select("source_key").join(counters, "source_key", "left")
        counters = counters.na.fill(0).na.fill(0.0)

    days = metrics.daily_revenue(good).groupBy("source_key").agg(
        F.sort_array(F.collect_list(F.struct("order_date", "daily_revenue"))).alias("daily_revenue")
    )
    ranked = F.sort_array(F.collect_list(F.struct("rank", "product_id", "total_revenue")))
    products = metrics.top_products(good).groupBy("source_key").agg(
        F.transform(ranked, lambda p: F.struct(p.product_id, p.total_revenue)).alias("top_products")
    )
    return (
        counters.join(days, "source_key", "left")
        .join(products, "source_key", "left")
        .select(
            "source_key",
            processed_at.alias("processed_at"),
            "total_rows",
            "good_rows",
            "bad_rows",
            "bad_row_rate",
            "payment_success_rate",
            _or_empty("daily_revenue", DAILY_REVENUE_TYPE),
            _or_empty("top_products", TOP_PRODUCTS_TYPE),
            python_round(duration_ms, 2).alias("duration_ms"),
        )
    )


def with_customers(
    records: DataFrame, customers: DataFrame, keys: tuple[str, ...] = ("source_key",)
) -> DataFrame:
    """Records with their complete orders_per_customer list, in the order of the fields.

    Gathers each asked-for file's list, so ask for the files or partitions needed. A list
    is gathered by blocks first: a task then sorts customers, which may go to disk, and
    never holds those of many files as objects.
    """
    block = F.pmod(F.xxhash64("customer_id"), F.lit(LIST_BLOCKS)).alias("_block")
    blocks = customers.groupBy(*keys, block).agg(
        F.collect_list(F.struct("customer_id", "order_count")).alias("_some")
    )
    lists = blocks.groupBy(*keys).agg(
        F.sort_array(F.flatten(F.collect_list("_some"))).alias("orders_per_customer")
    )
    names = [f.name for f in SUMMARY_FIELDS]
    joined = records.join(lists, list(keys), "left").withColumn(
        "orders_per_customer", _or_empty("orders_per_customer", ORDERS_PER_CUSTOMER_TYPE)
    )
    return joined.select(*names, *[c for c in records.columns if c not in names])


def _or_empty(name: str, data_type) -> Column:
    return F.coalesce(F.col(name), F.array().cast(data_type)).alias(name)
