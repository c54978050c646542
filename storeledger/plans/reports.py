"""The named daily reports over good_data and metadata.

`as_of` is the report day (default: today). Store and date filters are plain
comparisons on the partition columns, so only matching folders are read.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storeledger.contract import TOP_PRODUCTS
from storeledger.functions import product_sum, with_products

AsOf = dt.date | str | None


def _day(as_of: AsOf) -> Column:
    return F.current_date() if as_of is None else F.lit(str(as_of)).cast("date")


def _iso(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM-dd")


def _revenue_by(good_data: DataFrame, key: str, name: str) -> DataFrame:
    rows = with_products(good_data.select(key, "quantity", "unit_price"), "quantity", "unit_price")
    return rows.groupBy(key).agg(product_sum().alias(name))


def sanity_sample_rows(good_data: DataFrame, n: int = 20) -> DataFrame:
    """Any n rows."""
    return good_data.limit(n)


def single_partition_rows(
    good_data: DataFrame, store: str = "01", as_of: AsOf = None, n: int = 50
) -> DataFrame:
    """Rows of one store on one file date."""
    day = _iso(_day(as_of))
    return good_data.filter((F.col("store") == store) & (F.col("date") == day)).limit(n)


def store_daily_revenue(good_data: DataFrame, store: str = "01") -> DataFrame:
    """Revenue by file date for one store."""
    return _revenue_by(good_data.filter(F.col("store") == store), "date", "revenue").orderBy("date")


def day_store_revenue(good_data: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Revenue by store for one file date, highest first."""
    rows = good_data.filter(F.col("date") == _iso(_day(as_of)))
    return _revenue_by(rows, "store", "revenue").orderBy(F.desc("revenue"), "store")


def top_products_month(
    good_data: DataFrame, as_of: AsOf = None, n: int = TOP_PRODUCTS
) -> DataFrame:
    """Top products by revenue over the calendar month of the report day."""
    day = _day(as_of)
    first, last = _iso(F.trunc(day, "MONTH")), _iso(F.last_day(day))
    totals = _revenue_by(
        good_data.filter(F.col("date").between(first, last)), "product_id", "total_revenue"
    )
    return totals.orderBy(F.desc("total_revenue"), "product_id").limit(n)


def rolling_7d_metadata_summary(metadata: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Processing counters by file date and store since seven days before the report day."""
    since = _iso(F.date_sub(_day(as_of), 7))
    return (
        metadata.filter(F.col("date") >= since)
        .groupBy("date", "store")
        .agg(
            F.count(F.lit(1)).alias("files_processed"),
            F.sum("total_rows").alias("total_rows"),
            F.sum("good_rows").alias("good_rows"),
            F.sum("bad_rows").alias("bad_rows"),
            F.round(F.avg("bad_row_rate"), 4).alias("avg_bad_row_rate"),
            F.round(F.avg("payment_success_rate"), 4).alias("avg_payment_success_rate"),
            F.round(F.avg("duration_ms"), 2).alias("avg_duration_ms"),
        )
        .orderBy(F.desc("date"), "store")
    )
