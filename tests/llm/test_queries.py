"""The registered operator queries against their SQL, and the pipeline stage by stage."""

from __future__ import annotations

import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from check import TABLES, _comparable
from storeledger.llm import packing, quality, queries, secrets
from storeledger.llm.common import staged, word_count

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no tables here")


@pytest.fixture(scope="module")
def db():
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def test_every_operator_is_registered():
    assert {n.split("_")[0] for n in queries.queries()} == {f"op{i}" for i in range(1, 11)}
    assert {*queries.queries(), "pipeline"} <= set(entry.queries())


@pytest.mark.parametrize("name", list(queries.oracle_sql()))
def test_against_sql(spark, db, name):
    got = queries.queries()[name](spark, SF_DIR).toPandas()
    want = db.execute(queries.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert _comparable(got) == _comparable(want)


@pytest.mark.parametrize("name", ["op4_token_counts", "op6_substring_dedup", "op9_secret_scan",
                                  "op10_url_filter", "op3_best_fit_packing"])
def test_other_queries_cover_their_tables(spark, name):
    rows = queries.queries()[name](spark, SF_DIR)
    table = "pages" if name.startswith("op10") else "documents"
    total = spark.read.parquet(f"{SF_DIR}/{table}.parquet").count()
    if name == "op4_token_counts":
        assert rows.agg(F.sum("n_docs")).first()[0] == total
    elif name == "op3_best_fit_packing":
        assert rows.select("doc_id").distinct().count() == total
    else:
        assert rows.count() == total


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    extra = docs.limit(3).withColumn("doc_id", F.lit(None).cast("long"))
    docs = staged(docs.unionByName(docs.limit(5)).unionByName(extra), "pipeline-input")
    now = docs
    sizes = []
    for name, stage in corpus_pipeline.STAGES:
        before, now = now, staged(stage(spark, now, SF_DIR), name.replace(" ", "-"))
        sizes.append(now.count())
        if name == "quality rules":
            kept = quality.quality_rules(before).filter("kept").select("doc_id")
            assert Counter(r[0] for r in kept.collect()) == Counter(
                r.doc_id for r in now.select("doc_id").collect()
            )
        elif name == "near duplicates":
            ids = [r.doc_id for r in now.select("doc_id").collect() if r.doc_id is not None]
            assert len(ids) == len(set(ids)) and sizes[-1] < sizes[-2]
        elif name == "secret scans":
            assert sizes[-1] == sizes[-2]
            for row in now.collect():
                assert all(row.text[a:b].count("[SECRET]") for _, a, b in secrets.spans_of(row.text))
                assert row.n_chars == len(row.text)
        elif name == "mixing":
            assert now.columns == docs.columns
            held = now.groupBy("source").agg(F.sum(word_count(F.col("text"))).alias("n")).collect()
            assert len(held) > 1
        else:
            words = before.agg(F.sum(word_count(F.col("text")))).first()[0]
            assert now.agg(F.sum("length")).first()[0] == words
            used = now.groupBy("shard", "bin").agg(F.sum("length").alias("n"), F.max("capacity").alias("c"))
            assert used.filter("n > c").isEmpty()
            assert {r.c for r in used.collect()} <= set(packing.CAPACITIES)
