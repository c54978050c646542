"""Runs after runs: replacing, clearing, choosing the latest, and the stream."""

from __future__ import annotations

import os

import pytest

from storeledger.operators.verdicts import CHANGED
from storeledger.plans import staging
from storeledger.plans.ingest import examine, ingest
from storeledger.sources import landing, tables
from storeledger.streaming.arrivals import ingest_arrivals
from tests.conftest import HEADER, by_file, store_file

NAME = "store_01_20260418.csv"
GOOD = "A1,C1,P1,2024-02-01,1,7,paid"
BAD = "A2,C2,P2,2024-02-01,0,7,paid"


def _read(spark, out):
    def rows(reader, path):
        return sorted(
            tuple(str(v) for v in r) for r in reader(spark, f"{out}/{path}").collect()
        ) if os.path.exists(f"{out}/{path}") else []

    return {
        "good": rows(tables.read_good_data, "processed/good_data"),
        "bad": rows(tables.read_bad_data, "errors"),
        "rows": sorted(
            (r.store, r.date, r.total_rows, r.bad_rows)
            for r in tables.read_metadata(spark, f"{out}/metadata").collect()
        ),
    }


def test_rerun_gives_the_same_tables(spark, tmp_path):
    store_file(tmp_path / "raw", NAME, GOOD, BAD)
    ingest(spark, str(tmp_path / "raw"), str(tmp_path / "out"))
    first = _read(spark, tmp_path / "out")
    ingest(spark, str(tmp_path / "raw"), str(tmp_path / "out"))
    assert _read(spark, tmp_path / "out") == first
    assert len(first["good"]) == len(first["bad"]) == 1


def test_corrections_replace_earlier_rows(spark, tmp_path):
    raw, out = tmp_path / "raw", tmp_path / "out"
    store_file(raw, "store_02_20260418.csv", GOOD, BAD)
    store_file(raw, NAME, GOOD, BAD)
    ingest(spark, str(raw), str(out))
    # Clean after dirty: the error folder goes, the other store keeps its own.
    store_file(raw, NAME, GOOD)
    ingest(spark, str(raw / NAME), str(out))
    tables_now = _read(spark, out)
    assert [r[-2] for r in tables_now["bad"]] == ["02"]
    assert tables_now["rows"] == [("01", "2026-04-18", 1, 0), ("02", "2026-04-18", 2, 1)]
    # All bad after good: the good folder goes.
    store_file(raw, NAME, BAD)
    ingest(spark, str(raw / NAME), str(out))
    assert [r[-2] for r in _read(spark, out)["good"]] == ["02"]
    # Refused: earlier tables stay as they are.
    before = _read(spark, out)
    store_file(raw, NAME, "x", header="only")
    found = ingest(spark, str(raw / NAME), str(out))
    assert found.outcomes.first().status == "error"
    assert _read(spark, out) == before


def test_latest_upload_of_a_day_stands(spark, tmp_path):
    raw = tmp_path / "raw"
    old = store_file(raw / "b", NAME, GOOD, BAD)
    new = store_file(raw / "a", NAME, "N1,C1,P1,2024-02-01,1,7,paid")
    os.utime(old, (1_000_000_000, 1_000_000_000))
    os.utime(new, (1_100_000_000, 1_100_000_000))
    found = ingest(spark, str(raw), str(tmp_path / "out"))
    assert found.outcomes.filter("status = 'success'").count() == 2
    tables_now = _read(spark, tmp_path / "out")
    assert [r[0] for r in tables_now["good"]] == ["N1"]
    assert tables_now["bad"] == [] and tables_now["rows"] == [("01", "2026-04-18", 1, 0)]


def test_any_number_of_named_files_gives_the_same(spark, tmp_path, monkeypatch):
    """One file name per scan gives the same outcome as all in one."""
    raw = tmp_path / "raw"
    store_file(raw, "store_01_20260418.csv", GOOD, BAD)
    store_file(raw, "store_02_20260418.csv", "paid,A1,C1,P1,2024-02-01,1,7",
               header="payment_status,order_id,customer_id,product_id,order_date,quantity,unit_price")
    store_file(raw, "store_03_20260418.csv", 'A1,C1,"P\n1",2024-02-01,1,7,paid')
    store_file(raw, "store_04_20260418.csv", GOOD, header=HEADER + ",more")

    def look():
        found = examine(spark, str(raw))
        return (
            {k: (o.status, o.error) for k, o in by_file(found.outcomes.collect()).items()},
            {k: (s.total_rows, s.good_rows, s.daily_revenue) for k, s in by_file(found.summaries.collect()).items()},
        )

    usual = look()
    monkeypatch.setattr(staging, "FILES_PER_SCAN", 1)
    assert look() == usual
    assert usual[0]["store_04_20260418.csv"][0] == "error" and len(usual[1]) == 3


def test_later_arrivals_wait(spark, tmp_path):
    import datetime as dt

    path = store_file(tmp_path / "raw", NAME, GOOD)
    os.utime(path, (1_000_000_000, 1_000_000_000))
    early = dt.datetime.fromtimestamp(999_999_999, dt.timezone.utc)
    assert examine(spark, str(tmp_path / "raw"), arrived_by=early).outcomes.count() == 0


@pytest.mark.parametrize("change", ["rewritten", "removed"])
def test_files_that_change_between_the_scans_are_refused(spark, tmp_path, monkeypatch, change):
    raw, out = tmp_path / "raw", tmp_path / "out"
    path = store_file(raw, NAME, GOOD, BAD)
    store_file(raw, "store_02_20260418.csv", GOOD)
    ingest(spark, str(raw), str(out))
    first = _read(spark, out)

    def late_rows(*args):
        if change == "removed":
            path.unlink()
        else:
            store_file(raw, NAME, GOOD.replace("A1", "A9"))
            later = path.stat().st_mtime + 60
            os.utime(path, (later, later))
        return landing.raw_rows(*args)

    monkeypatch.setattr("storeledger.plans.ingest.raw_rows", late_rows)
    found = by_file(ingest(spark, str(raw), str(out)).outcomes.collect())
    assert found[NAME].status == "error" and found[NAME].error == CHANGED
    assert found["store_02_20260418.csv"].status == "success"
    assert _read(spark, out) == first


def test_stream_equals_batch(spark, tmp_path):
    raw = tmp_path / "raw"
    for n in range(5):
        store_file(raw, f"store_{n:02}_20260418.csv", GOOD, BAD, *[GOOD] * n)
    store_file(raw, "store_05_20260418.csv", "x", header="only")
    store_file(raw, "upload=store_06_20260418.csv/part-0.csv", GOOD)
    store_file(raw, "upload=store_06_20260418.csv/part-1.csv", BAD)
    seen = []
    query = ingest_arrivals(
        spark, str(raw), str(tmp_path / "streamed"), str(tmp_path / "checkpoint"), max_files=3,
        on_batch=lambda found: seen.extend(found.outcomes.collect()),
    )
    query.awaitTermination(300)
    assert query.exception() is None
    ingest(spark, str(raw), str(tmp_path / "batch"))
    assert _read(spark, tmp_path / "streamed") == _read(spark, tmp_path / "batch")
    assert {o.status for o in seen} == {"success", "error"}
    # A new file is taken by the next run, the old ones are not taken again.
    seen.clear()
    store_file(raw, "store_07_20260418.csv", GOOD)
    query = ingest_arrivals(
        spark, str(raw), str(tmp_path / "streamed"), str(tmp_path / "checkpoint"),
        on_batch=lambda found: seen.extend(found.outcomes.collect()),
    )
    query.awaitTermination(300)
    assert [o.store for o in seen] == ["07"]


def test_missing_landing_folder_is_an_error(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        examine(spark, str(tmp_path / "nowhere"))
