"""Reports, the daily batch, result records and catalogue partitions."""

from __future__ import annotations

import csv
import datetime as dt

import pytest
from pyspark.sql import functions as F

from storeledger.contract import GOOD_DATA_SCHEMA
from storeledger.plans import reports
from storeledger.plans.ingest import ingest
from storeledger.plans.report_batch import REPORTS, run_reports
from storeledger.sources import manifest, tables
from tests.conftest import store_file

TODAY = "2026-04-18"


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    raw, out = tmp_path_factory.mktemp("raw"), tmp_path_factory.mktemp("out")
    for store, price in (("01", 10), ("02", 30), ("03", 30)):
        for day in ("20260331", "20260401", "20260410", "20260411", "20260418", "20260430", "20260501"):
            store_file(raw, f"store_{store}_{day}.csv",
                       *[f"O{i},C1,P{i:02},2026-01-01,{i},{price},failed" for i in range(1, 13)],
                       "O0,C1,P1,2026-01-01,0,1,paid")
    ingest(spark, str(raw), str(out))
    good = tables.read_good_data(spark, f"{out}/processed/good_data")
    return good, tables.read_metadata(spark, f"{out}/metadata"), out


def test_samples(stored):
    good, _, _ = stored
    assert reports.sanity_sample_rows(good).count() == 20
    rows = reports.single_partition_rows(good, as_of=TODAY).collect()
    assert len(rows) == 12 and {(r.store, r.date) for r in rows} == {("01", TODAY)}


def test_revenue_reports_count_every_status(stored):
    good, _, _ = stored
    daily = reports.store_daily_revenue(good).collect()
    assert [r.date for r in daily] == sorted(r.date for r in daily) and len(daily) == 7
    assert {r.revenue for r in daily} == {780.0}
    by_store = reports.day_store_revenue(good, TODAY).collect()
    assert [(r.store, r.revenue) for r in by_store] == [("02", 2340.0), ("03", 2340.0), ("01", 780.0)]


def test_month_report_covers_the_calendar_month(stored):
    good, _, _ = stored
    top = reports.top_products_month(good, dt.date(2026, 4, 18)).collect()
    assert len(top) == 10 and (top[0].product_id, top[0].total_revenue) == ("P12", 12 * 70.0 * 5)


def test_rolling_report_has_a_lower_bound_only(stored):
    _, metadata, _ = stored
    rows = reports.rolling_7d_metadata_summary(metadata, TODAY).collect()
    assert [r.date for r in rows if r.store == "01"] == ["2026-05-01", "2026-04-30", "2026-04-18", "2026-04-11"]
    r = rows[0]
    assert (r.files_processed, r.total_rows, r.good_rows, r.bad_rows) == (1, 13, 12, 1)
    assert (r.avg_bad_row_rate, r.avg_payment_success_rate) == (0.0769, 0.0)
    assert r.avg_duration_ms == round(r.avg_duration_ms, 2) > 0


def test_default_day_is_today(stored):
    good, _, _ = stored
    assert reports.day_store_revenue(good).count() == 0


def _scan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_only_matching_folders_and_columns_are_read(stored):
    good, metadata, _ = stored
    plan = _scan(reports.single_partition_rows(good, as_of=TODAY))
    assert "PartitionFilters: [isnotnull(store" in plan and f"= {TODAY})" in plan
    plan = _scan(reports.top_products_month(good))
    assert "PartitionFilters: [isnotnull(date" in plan and "TakeOrderedAndProject" in plan
    assert "ReadSchema: struct<product_id:string,quantity:double,unit_price:double>" in plan
    assert "PartitionFilters: [isnotnull(date" in _scan(reports.rolling_7d_metadata_summary(metadata))


def test_stores_and_dates_stay_text(stored):
    good, _, _ = stored
    assert good.schema == GOOD_DATA_SCHEMA


def test_batch_writes_one_folder_per_report(spark, stored, tmp_path):
    good, metadata, _ = stored
    for _ in range(2):  # The second run replaces the first.
        runs = run_reports(spark, good, metadata, str(tmp_path), run_date="2026-04-19", as_of=TODAY)
        rows = {r.query_name: r.rows for r in runs.collect()}
    assert rows == {
        "sanity_sample_rows": 20, "single_partition_rows": 12, "store_daily_revenue": 7,
        "day_store_revenue": 3, "top_products_month": 10, "rolling_7d_metadata_summary": 12,
    }
    assert set(rows) == set(REPORTS)
    [result] = (tmp_path / "query_name=day_store_revenue/run_date=2026-04-19").glob("*.csv")
    with result.open() as f:
        assert list(csv.reader(f)) == [["store", "revenue"], ["02", "2340.0"], ["03", "2340.0"], ["01", "780.0"]]

    (tmp_path / "query_name=day_store_revenue/notes.txt").write_text("x")
    records = manifest.result_manifest(spark, str(tmp_path)).collect()
    record = [r for r in records if "day_store_revenue" in r.key][0]
    assert record.size_bytes == result.stat().st_size and record.key.endswith(result.name)
    assert record.created_at.endswith("+00:00") and record.event_type.endswith("query_result_created")
    counts = manifest.manifest_counts(spark, str(tmp_path))
    assert counts.published == len(records) and counts.skipped >= 1


def test_batch_needs_reports(spark, stored):
    with pytest.raises(ValueError):
        run_reports(spark, stored[0], stored[1], "unused", named={})


def test_catalogue_sees_new_partitions(spark, stored):
    good, _, out = stored
    tables.create_good_data_table(spark, "good_data_check", f"{out}/processed/good_data")
    tables.refresh_partitions(spark, "good_data_check")
    found = spark.table("good_data_check")
    assert found.count() == good.count()
    assert found.filter((F.col("store") == "01") & (F.col("date") == TODAY)).count() == 12
    spark.sql("DROP TABLE good_data_check")
