"""What stands: commits, late and failed runs, files sent again, uploads that are gone."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from storeledger.operators import health
from storeledger.operators.verdicts import CHANGED, MISSING
from storeledger.plans import ingest as job
from storeledger.plans import reports, sinks
from storeledger.sources import landing, ledger, manifest, tables
from storeledger.streaming.arrivals import ingest_arrivals
from storeledger.streaming.health import failure_events
from tests.conftest import by_file, store_file

NAME = "store_01_20260418.csv"
GOOD = "A1,C1,P1,2024-02-01,1,7,paid"
BAD = "A2,C2,P2,2024-02-01,0,7,paid"


def _orders(spark, out, path="processed/good_data"):
    reader = tables.read_bad_data if path == "errors" else tables.read_good_data
    return sorted((r.store, r.order_id) for r in reader(spark, f"{out}/{path}").collect())


def _row(order):
    return GOOD.replace("A1", order)


@pytest.mark.parametrize("broken", ["write_bad_data", "write_metadata", "write_alerts", "commit"])
def test_failed_run_leaves_every_table_as_it_was(spark, tmp_path, monkeypatch, broken):
    raw, out = tmp_path / "raw", str(tmp_path / "out")
    store_file(raw, NAME, _row("OLD"), BAD)
    job.ingest(spark, str(raw), out)
    before = {p: _orders(spark, out, p) for p in ("processed/good_data", "errors")}
    store_file(raw, NAME, _row("NEW"))

    def fail(*args, **kwargs):
        raise RuntimeError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(ledger if broken == "commit" else sinks, broken, fail)
        with pytest.raises(RuntimeError):
            job.ingest(spark, str(raw), out)
    assert {p: _orders(spark, out, p) for p in before} == before
    assert [r.bad_rows for r in tables.read_metadata(spark, f"{out}/metadata").collect()] == [1]
    job.ingest(spark, str(raw), out)  # Run again: repaired.
    assert _orders(spark, out) == [("01", "NEW")] and _orders(spark, out, "errors") == []


def test_latest_upload_stands_whatever_run_takes_it(spark, tmp_path):
    out = str(tmp_path / "out")
    new = store_file(tmp_path / "new", NAME, _row("NEW"), BAD)
    old = store_file(tmp_path / "old", NAME, _row("OLD"))
    store_file(tmp_path / "old", "store_02_20260418.csv", _row("OTHER"))
    os.utime(old, (1_000_000_000, 1_000_000_000))
    os.utime(new, (1_100_000_000, 1_100_000_000))
    for folder in ("new", "old"):
        found = job.ingest(spark, str(tmp_path / folder), out)
        assert found.outcomes.filter("status <> 'success'").isEmpty()
    assert _orders(spark, out) == [("01", "NEW"), ("02", "OTHER")]
    assert _orders(spark, out, "errors") == [("01", "A2")]
    # Sent again with a later time, the old content stands.
    os.utime(old, (1_200_000_000, 1_200_000_000))
    job.ingest(spark, str(tmp_path / "old"), out)
    assert _orders(spark, out) == [("01", "OLD"), ("02", "OTHER")]
    assert _orders(spark, out, "errors") == []
    # The folders that do not stand any more can go.
    assert sinks.sweep(spark, out) > 0
    assert _orders(spark, out) == [("01", "OLD"), ("02", "OTHER")]
    assert sinks.sweep(spark, out) == 0


def test_catalogue_of_another_session_follows_the_ledger(spark, tmp_path):
    out = str(tmp_path / "out")
    store_file(tmp_path / "a", NAME, _row("A"), BAD)
    job.ingest(spark, str(tmp_path / "a"), out)
    assert _orders(spark, out) == [("01", "A")]
    later = store_file(tmp_path / "b", NAME, BAD)
    os.utime(later, (4_000_000_000, 4_000_000_000))
    import datetime as dt

    far = dt.datetime(2200, 1, 1, tzinfo=dt.timezone.utc)
    job.ingest(spark, str(tmp_path / "b"), out, arrived_by=far)
    store_file(tmp_path / "c", "store_03_20260418.csv", _row("C"))
    job.ingest(spark, str(tmp_path / "c"), out)
    tables._SEEN.clear()  # As a session that finds the table in a shared catalogue.
    assert _orders(spark, out) == [("03", "C")]
    assert _orders(spark, out, "errors") == [("01", "A2")]


def test_report_lists_one_partition_of_many(spark, tmp_path):
    out = str(tmp_path / "out")
    for day in range(1, 29):
        store_file(tmp_path / "raw", f"store_01_202604{day:02}.csv", _row(f"O{day}"))
    job.ingest(spark, str(tmp_path / "raw"), out)
    good = tables.read_good_data(spark, f"{out}/processed/good_data")
    report = reports.day_store_revenue(good, "2026-04-18")
    assert [r.store for r in report.collect()] == ["01"]
    read = good.filter("date = '2026-04-18'").inputFiles()
    assert len(read) == 1 and "date=2026-04-18" in read[0]


@pytest.mark.parametrize("gone", [[NAME], [NAME, "store_02_20260418.csv"]])
def test_named_uploads_that_are_gone_do_not_stop_the_others(spark, tmp_path, gone):
    raw, out = tmp_path / "raw", str(tmp_path / "out")
    names = [NAME, "store_02_20260418.csv"]
    paths = [str(store_file(raw, n, GOOD)) for n in names]
    for name in gone:
        (raw / name).unlink()
    found = by_file(job.ingest(spark, paths, out).outcomes.collect())
    assert set(found) == set(names)
    for name in names:
        missing = name in gone
        assert (found[name].status, found[name].error) == (
            ("error", MISSING) if missing else ("success", None)
        )
    failed = tables.read_alerts(spark, f"{out}/alerts").filter("event_type = 'pipeline_failure'")
    assert failed.count() == len(gone)


def test_stream_goes_on_past_a_file_that_was_removed(spark, tmp_path, monkeypatch):
    """The checkpoint names the file; each delivery of the batch must cope without it."""
    raw, out = tmp_path / "raw", str(tmp_path / "out")
    path = store_file(raw, NAME, GOOD)
    store_file(raw, "store_02_20260418.csv", GOOD)
    seen = []
    real = job.examine

    def late(session, paths, **settings):
        if path.exists():
            path.unlink()
        return real(session, paths, **settings)

    monkeypatch.setattr(job, "examine", late)
    query = ingest_arrivals(
        spark, str(raw), out, str(tmp_path / "checkpoint"),
        on_batch=lambda found: seen.extend(found.outcomes.collect()),
    )
    query.awaitTermination(300)
    assert query.exception() is None
    found = by_file(seen)
    assert found[NAME].error == MISSING and found["store_02_20260418.csv"].status == "success"
    assert _orders(spark, out) == [("02", "A1")]


def test_rewrite_inside_one_tick_of_the_clock_is_refused(spark, tmp_path, monkeypatch):
    raw, out = tmp_path / "raw", str(tmp_path / "out")
    path = store_file(raw, NAME, GOOD)
    os.utime(path, (1_700_000_000, 1_700_000_000))

    def late_rows(*args):
        store_file(raw, NAME, GOOD, BAD)
        os.utime(path, (1_700_000_000, 1_700_000_000))
        return landing.raw_rows(*args)

    monkeypatch.setattr(job, "raw_rows", late_rows)
    [outcome] = job.ingest(spark, str(raw), out).outcomes.collect()
    assert (outcome.status, outcome.error) == ("error", CHANGED)


def test_changes_are_taken_once(spark, tmp_path):
    raw, out = tmp_path / "raw", str(tmp_path / "out")
    path = store_file(raw, NAME, _row("ONE"))
    store_file(raw, "store_02_20260418.csv", _row("TWO"))
    store_file(raw, "store_03_20260418.csv", "x", header="only")
    runs = job.ingest_changes(spark, str(raw), out, max_uploads=2)
    assert [r.outcomes.count() for r in runs] == [2, 1]
    assert job.ingest_changes(spark, str(raw), out) == []
    store_file(raw, NAME, _row("ONE AGAIN"))
    later = path.stat().st_mtime + 5
    os.utime(path, (later, later))
    import datetime as dt

    soon = dt.datetime.now(dt.timezone.utc) + dt.timedelta(minutes=1)
    [run] = job.ingest_changes(spark, str(raw), out, arrived_by=soon)
    assert [o.store for o in run.outcomes.collect()] == ["01"]
    assert _orders(spark, out) == [("01", "ONE AGAIN"), ("02", "TWO")]


def test_results_are_told_once(spark, tmp_path):
    root, told = tmp_path / "results", str(tmp_path / "told")
    one = store_file(root / "query_name=a/run_date=2026-04-18", "one.csv", "x")
    store_file(root / "query_name=b/run_date=2026-04-18", "two.csv")
    (root / "query_name=b/run_date=2026-04-18/two.txt").write_text("not a result")
    news = manifest.new_results(spark, str(root), told).collect()
    assert {(f"/{r.key}", r.size_bytes) for r in news} == {
        (str(p), p.stat().st_size) for p in root.rglob("*.csv")
    }
    assert all(r.s3_uri.endswith(f"/{r.key}") for r in news)
    assert manifest.new_results(spark, str(root), told).isEmpty()
    store_file(one.parent, "one.csv", "x", "written again")
    assert [r.key.rsplit("/", 1)[1] for r in manifest.new_results(spark, str(root), told).collect()] == [
        "one.csv"
    ]
    counts = manifest.manifest_counts(spark, str(root))
    assert (counts.published, counts.skipped) == (2, 1)


def test_failed_uploads_raise_the_error_alarm(spark, tmp_path):
    out, seen = str(tmp_path / "out"), []
    for n in range(3):
        store_file(tmp_path / "raw", f"store_0{n}_20260418.csv", "x", header="only")
    store_file(tmp_path / "raw", "store_09_20260418.csv", GOOD)
    job.ingest(spark, str(tmp_path / "raw"), out)
    alarms = health.error_alarms(failure_events(spark, out), "ts", F.col("status") == "error")
    query = (
        alarms.writeStream.outputMode("complete")
        .foreachBatch(lambda rows, _: seen.extend(rows.collect()))
        .option("checkpointLocation", str(tmp_path / "checkpoint"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination(120)
    assert [r.errors for r in seen] == [3]
