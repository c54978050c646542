"""The ledger: which run's folder stands for each store and date.

Every run writes its tables below folders of its own, named by a version, and then one
ledger folder with a row per upload. The success marker of that folder is the commit:
until it is there no reader sees anything of the run, and a run that failed before is
never seen. For each store and date the accepted upload with the latest modification
time stands, whichever run took it, and of runs that took the same upload the last one.
So an old upload that is run late replaces nothing, and runs need no lock.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storeledger.contract import LEDGER_SCHEMA, TAKEN_FILES_SCHEMA
from storeledger.plans import storage

UPLOADS, FILES = "ledger/uploads", "ledger/files"


def commits(spark: SparkSession, output: str) -> list[str]:
    """Versions of the committed runs, oldest name first: one folder each."""
    marks = storage.matching(spark, f"{output.rstrip('/')}/{UPLOADS}/version=*/_SUCCESS")
    return [m.rsplit("/", 2)[1].removeprefix("version=") for m in marks]


def _read(spark: SparkSession, root: str, schema, versions: list[str]) -> DataFrame:
    if not versions:
        return spark.createDataFrame([], schema)
    folders = [f"{root}/version={v}" for v in versions]
    return spark.read.schema(schema).option("basePath", root).parquet(*folders)


def uploads(spark: SparkSession, output: str, versions: list[str] | None = None) -> DataFrame:
    """The uploads that committed runs took, with their outcome."""
    versions = commits(spark, output) if versions is None else versions
    return _read(spark, f"{output.rstrip('/')}/{UPLOADS}", LEDGER_SCHEMA, versions)


def taken_files(spark: SparkSession, output: str) -> DataFrame:
    """The files that committed runs took, as they were then."""
    root = f"{output.rstrip('/')}/{FILES}"
    return _read(spark, root, TAKEN_FILES_SCHEMA, commits(spark, output))


def standing(taken: DataFrame) -> DataFrame:
    """The row that stands for each store and date."""
    order = F.struct("modified_at", "source_key", "committed_at", "version")
    row = F.struct(*[c for c in taken.columns if c not in ("store", "date")])
    return (
        taken.filter("status = 'success'")
        .groupBy("store", "date")
        .agg(F.max_by(row, order).alias("row"))
        .select("store", "date", "row.*")
    )


def commit(
    outcomes: DataFrame, counts: DataFrame, files: DataFrame, version: str, output: str
) -> None:
    """Make a run's folders visible. Called last, when all its tables are written.

    `counts` has good_rows and bad_rows per source_key, `files` the files read.
    """
    output = output.rstrip("/")
    now = F.lit(dt.datetime.now(dt.timezone.utc))
    rows = outcomes.join(counts.select("source_key", "good_rows", "bad_rows"), "source_key", "left")
    _write(files, TAKEN_FILES_SCHEMA, f"{output}/{FILES}/version={version}")
    _write(
        rows.withColumn("committed_at", now), LEDGER_SCHEMA, f"{output}/{UPLOADS}/version={version}"
    )


def _write(rows: DataFrame, schema, path: str) -> None:
    fields = [F.col(f.name).cast(f.dataType) for f in schema if f.name != "version"]
    rows.select(*fields).write.option(
        "mapreduce.fileoutputcommitter.marksuccessfuljobs", "true"
    ).parquet(path)
