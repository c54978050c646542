"""The lists of customers are gathered without many files' rows in one task's memory."""

from pyspark.sql import functions as F

from storeledger.contract import SUMMARY_FIELDS
from storeledger.operators import summary


def test_lists_of_customers_are_gathered_by_blocks(spark):
    customers = spark.range(1000).select(
        F.concat(F.lit("f"), F.col("id") % 2).alias("source_key"),
        F.col("id").cast("string").alias("customer_id"),
        (F.col("id") % 5).alias("order_count"),
    )
    kept = [f for f in SUMMARY_FIELDS if f.name not in ("source_key", "orders_per_customer")]
    records = spark.createDataFrame([("f0",), ("f1",), ("f2",)], "source_key string").select(
        "source_key", *[F.lit(None).cast(f.dataType).alias(f.name) for f in kept]
    )
    whole = summary.with_customers(records, customers)
    for row in whole.select("source_key", "orders_per_customer").collect():
        ids = range(int(row.source_key[1:]), 1000, 2) if row.source_key != "f2" else ()
        expected = sorted((str(i), i % 5) for i in ids)
        assert [tuple(e) for e in row.orders_per_customer] == expected
    # The rows of a file meet in blocks first; only blocks are put together to its list.
    assert "flatten(collect_list(" in whole._jdf.queryExecution().optimizedPlan().toString()
