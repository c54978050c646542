"""Registered queries against their SQL on the smallest tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry
from check import TABLES, _comparable
from storeledger.plans import catalog

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no order tables here")


@pytest.fixture(scope="module")
def db():
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", list(catalog.queries()))
def test_query(spark, db, name):
    got = catalog.queries()[name](spark, SF_DIR).toPandas()
    if name not in catalog.oracle_sql():
        assert name in ("report_sample", "report_partition_rows")
        assert list(got.columns)[-2:] == ["store", "date"]
        return
    want = db.execute(catalog.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert _comparable(got) == _comparable(want)


def test_entry(spark):
    frame = entry.entry(spark)
    assert frame.columns == ["source_key", "order_date", "daily_revenue"] and not frame.isEmpty()
