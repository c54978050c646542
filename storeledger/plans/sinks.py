"""The output tables, partitioned by store and date, safe to write again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from storeledger.contract import (
    ALERTS_SCHEMA,
    BAD_DATA_PATH,
    CUSTOMER_ORDERS_PATH,
    GOOD_DATA_PATH,
    INPUT_COLUMNS,
    METADATA_PATH,
    OUTCOMES_SCHEMA,
    PARTITION_COLUMNS,
    STORED_SUMMARY_FIELDS,
)
from storeledger.plans import storage
from storeledger.sources import ledger


def _partitioned(rows: DataFrame, columns: list[str], version: str | None):
    """Rows of a partition together, large partitions split, only those replaced.

    With a version, each partition's files lie in a folder of it, beside those of other
    versions, and nothing is replaced.
    """
    keys = list(PARTITION_COLUMNS)
    rows = rows.select(*columns, *keys).hint("rebalance", *keys)
    if version is not None:
        keys.append("version")
        rows = rows.withColumn("version", F.lit(version))
    return (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*keys)
    )


def write_good_data(rows: DataFrame, root: str, version: str | None = None) -> None:
    _partitioned(rows, list(INPUT_COLUMNS), version).option("compression", "snappy").parquet(root)


def write_bad_data(rows: DataFrame, root: str, version: str | None = None) -> None:
    (
        _partitioned(rows, [*INPUT_COLUMNS, "validation_errors"], version)
        .option("header", True)
        .option("escape", '"')
        .option("emptyValue", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(root)
    )


def write_metadata(summaries: DataFrame, root: str, version: str | None = None) -> None:
    _partitioned(summaries, [f.name for f in STORED_SUMMARY_FIELDS], version).json(root)


def write_customer_orders(rows: DataFrame, root: str, version: str | None = None) -> None:
    _partitioned(rows, ["source_key", "customer_id", "order_count"], version).parquet(root)


def sweep(spark: SparkSession, output: str) -> int:
    """Remove folders of the output tables that no longer stand; how many there were.

    For folders whose later version is committed. Readers that have begun before that
    may still use them, so sweep when none of those is left.
    """
    output = output.rstrip("/")
    stood = ledger.uploads(spark, output).filter("status = 'success'")
    now = ledger.standing(stood).select(*PARTITION_COLUMNS, F.col("version").alias("stands"))
    old = stood.join(now, list(PARTITION_COLUMNS)).filter("version <> stands")
    removed = 0
    for row in old.select(*PARTITION_COLUMNS, "version").distinct().toLocalIterator():
        below = "/".join(f"{c}={row[c]}" for c in (*PARTITION_COLUMNS, "version"))
        for path in (GOOD_DATA_PATH, BAD_DATA_PATH, METADATA_PATH, CUSTOMER_ORDERS_PATH):
            if storage.exists(spark, f"{output}/{path}/{below}"):
                storage.remove(spark, f"{output}/{path}/{below}")
                removed += 1
    return removed


def write_outcomes(outcomes: DataFrame, run_id: str, root: str) -> None:
    _of_run(outcomes, OUTCOMES_SCHEMA, run_id, root)


def write_alerts(alerts: list[DataFrame], run_id: str, root: str) -> None:
    """Alerts of all kinds in one table; fields that a kind lacks are null."""
    rows = alerts[0]
    for more in alerts[1:]:
        rows = rows.unionByName(more, allowMissingColumns=True)
    _of_run(rows, ALERTS_SCHEMA, run_id, root)


def _of_run(rows: DataFrame, schema: StructType, run_id: str, root: str) -> None:
    """Replace what a run has written before, and nothing else."""
    fields = [F.col(f.name).cast(f.dataType) for f in schema if f.name != "run_id"]
    # One folder per run, even for a run without rows; repeating a run repeats its folder.
    rows.select(*fields).write.mode("overwrite").parquet(f"{root}/run_id={run_id}")
