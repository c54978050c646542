"""The corpus pipeline: rules, near duplicates, secrets, mixing, packing.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept, and
returns the columns of `documents`; the last returns where each piece is packed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storeledger.llm import mixing, near_dup, packing, quality, secrets
from storeledger.llm.common import staged, word_count


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep.

    The verdict is computed beside the row, in a chain of projections; rows that repeat
    an id are judged each.
    """
    return quality.kept_documents(docs)


def near_dup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five-word shingles, 0.8 or more.

    Rows that repeat an id stand or fall by their own texts; of rows that repeat id and
    text, one stays. Rows with a null id all stay.
    """
    return near_dup.kept_documents(docs, shingle=5)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, secrets masked in its text; n_chars follows."""
    return secrets.redact_secrets(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix takes, once per pass that holds their first word.

    A source's words come near its target, to within one document; a document that
    passes repeat stands in as many rows.
    """
    return mixing.documents_taken(docs, word_count(F.col("text")))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies: shard, bin, offset, and the bin's capacity."""
    return packing.pack(docs, word_count(F.col("text")))


STAGES = [
    ("quality rules", quality_stage),
    ("near duplicates", near_dup_stage),
    ("secret scans", secrets_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

# The near-duplicate stage hashes and the packing stage is a loop: no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; each stage's rows are written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
