"""Readers of the output tables, with declared schemas.

Inference would read store '01' as the number 1 and an empty list as strings.

A table that `ingest` writes is a catalogue table: its partitions are those that the
ledger says stand, each with the folder of the run that wrote it. A filter on store and
date asks the catalogue for the partitions that fit, so a report lists their folders and
no others, however many the table has. A folder that no ledger stands beside is read as
it is, all of its partitions found at each read.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from storeledger.contract import (
    ALERTS_SCHEMA,
    BAD_DATA_PATH,
    BAD_DATA_SCHEMA,
    CUSTOMER_ORDERS_PATH,
    CUSTOMER_ORDERS_SCHEMA,
    GOOD_DATA_PATH,
    GOOD_DATA_SCHEMA,
    METADATA_PATH,
    METADATA_SCHEMA,
    OUTCOMES_SCHEMA,
    PARTITION_COLUMNS,
)
from storeledger.operators import summary
from storeledger.plans import storage
from storeledger.sources import ledger

# Partitions that one statement names.
PARTITIONS_PER_STATEMENT = 500
_SYNCED = "storeledger.synced"
# The commits that a session's tables have seen.
_SEEN: dict[tuple[str, str], list[str]] = {}


@dataclass(frozen=True)
class Kind:
    """A partitioned output table: where it is, its form, and when a partition has rows."""

    path: str
    schema: StructType
    form: str
    options: tuple[tuple[str, str], ...] = ()
    has_rows: str = "true"


_CSV = (("header", "true"), ("escape", '"'), ("multiLine", "true"))  # Fields may hold line breaks.
GOOD_DATA = Kind(GOOD_DATA_PATH, GOOD_DATA_SCHEMA, "parquet", has_rows="good_rows > 0")
BAD_DATA = Kind(BAD_DATA_PATH, BAD_DATA_SCHEMA, "csv", _CSV, has_rows="bad_rows > 0")
METADATA = Kind(METADATA_PATH, METADATA_SCHEMA, "json")
CUSTOMER_ORDERS = Kind(
    CUSTOMER_ORDERS_PATH, CUSTOMER_ORDERS_SCHEMA, "parquet", has_rows="good_rows > 0"
)
KINDS = (GOOD_DATA, BAD_DATA, METADATA, CUSTOMER_ORDERS)


def read_good_data(spark: SparkSession, root: str) -> DataFrame:
    return _read(spark, root, GOOD_DATA)


def read_bad_data(spark: SparkSession, root: str) -> DataFrame:
    return _read(spark, root, BAD_DATA)


def read_metadata_records(spark: SparkSession, root: str) -> DataFrame:
    """One record per file, as stored: without the list of customers."""
    return _read(spark, root, METADATA)


def read_customer_orders(spark: SparkSession, root: str) -> DataFrame:
    """A row per customer of each file."""
    return _read(spark, root, CUSTOMER_ORDERS)


def read_metadata(spark: SparkSession, root: str, customers_root: str | None = None) -> DataFrame:
    """One record per file, complete with its list of customers.

    The customers stand beside the metadata unless `customers_root` says otherwise. A
    filter on store and date reaches both tables.
    """
    if customers_root is None:
        customers_root = f"{root.rstrip('/').rpartition('/')[0]}/{CUSTOMER_ORDERS_PATH}"
    return summary.with_customers(
        read_metadata_records(spark, root),
        read_customer_orders(spark, customers_root),
        keys=("store", "date", "source_key"),
    )


def read_outcomes(spark: SparkSession, root: str) -> DataFrame:
    """What became of each upload, run by run."""
    return spark.read.schema(OUTCOMES_SCHEMA).parquet(root)


def read_alerts(spark: SparkSession, root: str) -> DataFrame:
    """High-error and failure alerts, run by run."""
    return spark.read.schema(ALERTS_SCHEMA).parquet(root)


def _read(spark: SparkSession, root: str, kind: Kind) -> DataFrame:
    output = _output(spark, root, kind)
    if output:
        return spark.table(synced(spark, output, kind))
    reader = spark.read.schema(kind.schema)
    for option, value in kind.options:
        reader = reader.option(option, value)
    return reader.format(kind.form).load(root)


# --- Catalogue --------------------------------------------------------------------------------


def table_name(spark: SparkSession, output: str, kind: Kind) -> str:
    """The name of an output's table in the session's catalogue."""
    place = hashlib.md5(storage.qualified(spark, output.rstrip("/")).encode()).hexdigest()
    return f"default.{kind.path.rpartition('/')[2]}_{place}"


def create_table(
    spark: SparkSession, name: str, root: str, kind: Kind = GOOD_DATA, **properties: str
) -> None:
    """Catalogue entry over a table's folder, without partitions yet."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kind.schema)
    options = ", ".join(f"{_quoted(k)} {_quoted(v)}" for k, v in kind.options)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING {kind.form} "
        + (f"OPTIONS ({options}) " if options else "")
        + f"PARTITIONED BY ({', '.join(PARTITION_COLUMNS)}) LOCATION {_quoted(root)}"
        + (f" TBLPROPERTIES ({_properties(properties)})" if properties else "")
    )


def create_good_data_table(spark: SparkSession, name: str, root: str) -> None:
    """Catalogue entry over a good_data folder; `refresh_partitions` adds what is there."""
    create_table(spark, name, root, GOOD_DATA)


def refresh_partitions(spark: SparkSession, name: str, kind: Kind = GOOD_DATA) -> None:
    """Bring a table up to its ledger or, without one, to the folders found below its root."""
    said = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Location'").first()
    output = _output(spark, said["data_type"], kind)
    if output:
        _sync(spark, name, output, kind, ledger.commits(spark, output))
    else:
        spark.sql(f"MSCK REPAIR TABLE {name}")


def _output(spark: SparkSession, root: str, kind: Kind) -> str | None:
    """The output folder that a table's root belongs to, if a ledger stands beside it."""
    root = root.rstrip("/")
    output = root.removesuffix(f"/{kind.path}")
    return output if root != output and storage.exists(spark, f"{output}/{ledger.UPLOADS}") else None


def register_partitions(
    spark: SparkSession, name: str, root: str, partitions: Iterable[tuple[str, str, str]]
) -> None:
    """Add (store, date, folder below the partition) to a table; none is looked for."""
    partitions = iter(partitions)
    while chunk := list(itertools.islice(partitions, PARTITIONS_PER_STATEMENT)):
        named = " ".join(
            f"{_spec(store, date)} LOCATION {_quoted(_folder(root, store, date, below))}"
            for store, date, below in chunk
        )
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {named}")


def synced(spark: SparkSession, output: str, kind: Kind) -> str:
    """The catalogue table of an output, brought up to the ledger's last commit."""
    output = output.rstrip("/")
    name = table_name(spark, output, kind)
    versions = ledger.commits(spark, output)
    session = (spark.sparkContext.applicationId, name)
    there = spark.catalog.tableExists(name)
    if there and _SEEN.get(session) == versions:
        return name
    if not there:
        create_table(spark, name, f"{output}/{kind.path}", kind)
    _sync(spark, name, output, kind, versions)
    _SEEN[session] = versions
    return name


def _sync(
    spark: SparkSession, name: str, output: str, kind: Kind, versions: list[str]
) -> None:
    """Register what stands in a table.

    The table keeps the time of the last commit it has seen. Only partitions that later
    commits name, or commits of the hour before, whose clocks may differ, are looked at:
    those that have another folder now are switched, those without rows dropped.
    """
    root = f"{output}/{kind.path}"
    said = spark.sql(f"SHOW TBLPROPERTIES {name}").filter(F.col("key") == _SYNCED).first()
    taken = ledger.uploads(spark, output, versions).filter("status = 'success'")
    fresh = taken
    if said:
        fresh = taken.filter(F.col("committed_at") > F.lit(said["value"]).cast("timestamp") - F.expr("INTERVAL 1 HOUR"))
    keys = list(PARTITION_COLUMNS)
    stands = ledger.standing(taken).join(fresh.select(*keys).distinct(), keys)
    stands = stands.select(*keys, "version", F.expr(kind.has_rows).alias("has_rows"))
    others = taken.filter(kind.has_rows).select(*keys, F.col("version").alias("other"))
    change = (
        stands.join(others, keys, "left")
        .groupBy(*keys, "version", "has_rows")
        .agg(F.coalesce(F.max(F.col("other") != F.col("version")), F.lit(False)).alias("before"))
        .orderBy(*keys)
    )
    added = []
    for row in change.toLocalIterator():
        spec = _spec(row.store, row.date)
        if not row.has_rows:
            if row.before:
                spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {spec}")
            continue
        if row.before:
            where = _quoted(_folder(root, row.store, row.date, f"version={row.version}"))
            spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {spec} LOCATION {where}")
            spark.sql(f"ALTER TABLE {name} {spec} SET LOCATION {where}")
            continue
        added.append((row.store, row.date, f"version={row.version}"))
        if len(added) == PARTITIONS_PER_STATEMENT:
            register_partitions(spark, name, root, added)
            added = []
    register_partitions(spark, name, root, added)
    last = taken.agg(F.max("committed_at").cast("string").alias("at")).first()["at"]
    if last:
        spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({_properties({_SYNCED: last})})")
    spark.catalog.refreshTable(name)


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _properties(values: dict[str, str]) -> str:
    return ", ".join(f"{_quoted(k)} = {_quoted(v)}" for k, v in values.items())


def _spec(store: str, date: str) -> str:
    return f"PARTITION (store = {_quoted(store)}, date = {_quoted(date)})"


def _folder(root: str, store: str, date: str, below: str = "") -> str:
    return "/".join(filter(None, [root, f"store={store}", f"date={date}", below]))
