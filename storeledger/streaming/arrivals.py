"""Files processed as they arrive.

The stream carries file paths only, never contents. Each micro-batch runs the
batch job on the uploads it names, so per-file rules hold and a batch that is
delivered again writes the same partitions again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from storeledger.plans.ingest import Ingested, ingest
from storeledger.plans.staging import scratch
from storeledger.sources.names import source_key

# Paths a micro-batch may name; they pass through the driver.
MAX_FILES_PER_BATCH = 1_000


def arrivals(
    spark: SparkSession, landing: str, max_files: int = MAX_FILES_PER_BATCH
) -> DataFrame:
    """New CSVs below the landing folder: upload path and modification time."""
    files = (
        spark.readStream.format("binaryFile")
        .schema("path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "{*.csv,part-*}")
        .option("maxFilesPerTrigger", max_files)
        .load(landing)
    )
    path = F.col("path")
    files = files.filter(path.endswith(".csv") | path.contains(".csv/part-"))
    return files.select(source_key(path).alias("upload"), "modificationTime")


def ingest_arrivals(
    spark: SparkSession,
    landing: str,
    output: str,
    checkpoint: str,
    max_files: int = MAX_FILES_PER_BATCH,
    on_batch: Callable[[Ingested], None] | None = None,
    trigger: dict | None = None,
    **settings,
) -> StreamingQuery:
    """Start the stream; by default it takes what is there and stops.

    When one part of a multi-part upload arrives, the upload is read again whole.
    Each file is taken once: the file source ignores a path that is rewritten, so
    send corrections under a new folder, or run the batch job on them.
    """

    def process(batch: DataFrame, batch_id: int) -> None:
        named = batch.groupBy("upload").agg(F.max("modificationTime").alias("at")).collect()
        if not named:
            return
        latest = max(row.at for row in named)
        now = batch.sparkSession.sql("SELECT current_timestamp() AS now").first().now
        # What the batch staged goes when it is done; its tables stay.
        with scratch(batch.sparkSession):
            found = ingest(
                batch.sparkSession,
                [row.upload for row in named],
                output,
                run_id=f"batch-{batch_id:012d}",
                arrived_by=max(latest, now),
                **settings,
            )
            if on_batch:
                on_batch(found)

    return (
        arrivals(spark, landing, max_files)
        .writeStream.foreachBatch(process)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
