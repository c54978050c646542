"""Landing zone to tables: accepted, refused and odd files in one run."""

from __future__ import annotations

import csv
import json

import pytest

from storeledger.operators.verdicts import MIXED_DATES, OVERLONG, UNDECODABLE
from storeledger.plans.ingest import ingest
from storeledger.sources import tables
from tests.conftest import HEADER, by_file, store_file

DAY = "20260418"


def _write_landing(raw):
    def put(number, *lines, day=DAY, **kw):
        return store_file(raw, f"store_{number}_{day}.csv", *lines, **kw)

    # Row rules, shaped like the scenario table of FIXTURES.md.
    put("01", "A1,C1,P1,2024-02-01,2,10,paid", "A2,C2,P2,2024-02-01,1,20,pending",
        "A3,C3,P3,2024-02-02,3,20,failed")
    put("04", *["B1,C1,P1,2024-02-06,1,40,paid"] * 2, *["B2,C2,P2,2024-02-06,1,50,paid"] * 2,
        *["B3,C3,P3,2024-02-06,1,50,failed"] * 2)
    put("08", "D1,C1,P1,2024-02-09,-1,5,paid", "D2,C2,P2,2024-02-09,1,0,paid",
        "D3,C3,P3,2024-02-09,,5,paid", "D4,C4,P4,2024-02-09,1,,PAID_OK",
        "D5,C5,P5,2024-02-09,1,5,")
    put("09", "E1,C1,P1,2024-02-10,1,5,paid,S9,X", header=HEADER + ",store_id,promo_code")
    put("10", "F1,  ,P1,2024-02-13,1,5,paid", "F2,C2,,2024-02-13,1,5,paid",
        "F3,C3,P3,   ,1,5,paid", "F4,C4,P4,2024-02-13,4,10,paid", "F5,C5,P5,2024-02-13,2,20,paid")
    put("11", "Q7,K3,R1,2023-11-30,5,4.20,failed", "Q8,K9,R4,2023-12-02,1,17.50,PAID",
        "Q9,K3,R1,2023-12-02,2,6,pending")
    put("12", "H1,C1,P1,2024-02-16,1,paid", header=HEADER.replace("unit_price,", ""))
    put("13", "T1,K1,R9,2023-08-07,6,2.25,paid", "T2,K2,R9,2023-08-08,0,8,pending",
        "T3,,R2,2023-08-08,1,3,failed", "T1,K1,R9,2023-08-07,6,2.25,paid",
        "T4,K4,R3,2023-08-09,2,,unpaid", 'T5,"K\n""5"", x",R3,2023-08-09,0,1,paid')

    # Layout of the file.
    put("20", "paid,2,10,P1,A1,C1,2024-02-01", "failed,1,5,P2,A2,C2,2024-02-02",
        header="payment_status,quantity,unit_price,product_id,order_id,customer_id,order_date")
    put("21", "A1,C1,P1,2024-02-01,1,1,paid,x", header=HEADER.replace("customer_id", "order_id"))
    (raw / f"store_22_{DAY}.csv").write_bytes(
        b"\xef\xbb\xbf" + f"{HEADER}\r\nA1,C1,P1,2024-02-01,2,3,paid\r\n".encode())
    put("23", "", "A1,C1,P1,2024-02-01,1,7,paid", "   ", "A2,C2,P2,2024-02-01", "")
    put("24", "A1,C1,P1,2024-02-01,1,7,paid", "A2,C2,P2,2024-02-01,1,7,paid,")
    put("25", "A1,C1,P1,2024-02-01,1,7,paid,x", "A2,C2,P2,2024-02-01,1,7,paid,y")
    put("26")
    put("27", "A1,C1,P1,2024-02-01,1,7,paid", header=",".join(f'"{c}"' for c in HEADER.split(",")))
    put("28", 'A1,C1,"P1\nlong, ""name""",2024-02-01,2,7,paid', "   ", 'A2,"",P2,2024-02-01,1,1,paid')
    (raw / f"store_29_{DAY}.csv").write_bytes(f"{HEADER}\nA\xff1,C1,P1,2024-02-01,1,1,paid\n".encode("latin-1"))
    (raw / f"store_30_{DAY}.csv").write_text("\n  \n")
    put("31", "A1,C1,P1,2024-02-01,1,1,paid", header="\n" + HEADER.replace("order_id", "Order_id"))

    # Fields.
    put("40", "NA,C1,P1,2024-02-01,1,1,paid", "null,C1,P1,2024-02-01,1,1,paid",
        "none,C1,P1,2024-02-01,1,1,paid", "A4,None,P1,2024-02-01,1,1,paid",
        "A5, ,P1,2024-02-01,1,1,paid", "A6,C6,P6,2024-02-01,1,1, paid")
    put("41", *[f"A{i},C1,P1,2024-02-01,{q},1,paid" for i, q in enumerate(
        ["abc", " 3 ", "1e3", '"1,000"', "1d", "NaN", "inf", "1e400", "0x10", "-0"])])
    put("42", "A1,C1,P1,2024-02-01,1,2.0,paid", "A1,C1,P1,2024-02-01,1.0,2,paid",
        "A2,C1,P1,2024-02-01,x,2,paid", "A2,C1,P1,2024-02-01,y,2,paid", "A2,C1,P1,2024-02-01,y,2.00,paid")

    # Dates.
    put("50", "A1,C1,P1,not a date,0,1,paid", "A2,C1,P1,2024-1-5,1,1,paid")
    put("51", "A1,C1,P1,2024-13-45,1,1,paid", "A2,C1,P1,2024-01-05,1,1,paid")
    put("52", "A1,C1,P1,2024-01-05,1,1,paid", "A2,C1,P1,2024-01-05 10:00:00,1,1,paid")
    put("53", "A1,C1,P1,2024-01-05 10:00:00,1,1,paid", "A2,C1,P1,2024-01-05 23:59:59,1,1,paid")
    put("54", "A1,C1,P1,2024/01/05,1,1,paid")
    put("55", "A1,C1,P1,20240105,1,1,paid")
    put("57", "A1,C1,P1,7/4/2023,1,3,paid", "A2,C1,P1,11/28/2023,1,2,paid")
    put("58", "A1,C1,P1,07/04/2023,1,3,paid", "A2,C1,P1,2023/07/04,1,2,paid")
    put("56", "A1,C1,P1,2300-01-01,1,1,paid")

    # Names.
    store_file(raw, f"shop_1_{DAY}.csv", "A1,C1,P1,2024-02-01,1,1,paid")
    put("60", "A1,C1,P1,2024-02-01,1,1,paid", day="20261399")
    store_file(raw, f"store_61_{DAY}.csv.txt", "not read")

    # An upload written in parallel: a folder of parts, each with a header.
    for part in ("part-0.csv", "part-1.csv"):
        store_file(raw, f"upload=store_70_{DAY}.csv/{part}", "A1,C1,P1,2024-02-01,1,5,paid")

    # The same, as Spark writes a folder without being asked for a suffix.
    for part in ("part-00000", "part-00001"):
        store_file(raw, f"store_71_{DAY}.csv/{part}", "A1,C1,P1,2024-02-01,1,5,paid")
    store_file(raw, "elsewhere/part-00000", "not an upload")

    # A name that a URL would encode, and an upload without a byte.
    store_file(raw, f"sub 1+2%/store_72_{DAY}.csv", "A1,C1,P1,2024-02-01,1,5,paid")
    (raw / f"store_73_{DAY}.csv").write_bytes(b"")

    # Rates: one bad row in 32; exactly the alert threshold.
    put("80", *[f"A{i},C1,P1,2024-02-01,{int(i > 0)},1,paid" for i in range(32)])
    put("81", *[f"A{i},C1,P1,2024-02-01,{int(i > 0)},1,paid" for i in range(5)])


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    raw, out = tmp_path_factory.mktemp("raw"), tmp_path_factory.mktemp("out")
    _write_landing(raw)
    names = [(f"{str(raw)[1:]}/store_{n}_{DAY}.csv",) for n in ("01", "73")]
    expected = spark.createDataFrame(names, "source_key string")
    found = ingest(
        spark, str(raw), str(out), run_id="one", source_bucket="landing", expected=expected
    )
    return {
        "raw": raw,
        "out": out,
        "found": found,
        "outcomes": by_file(found.outcomes.collect()),
        "summaries": by_file(found.summaries.collect()),
        "written": {
            "outcomes": tables.read_outcomes(spark, f"{out}/outcomes").collect(),
            "alerts": tables.read_alerts(spark, f"{out}/alerts").collect(),
        },
        "good": tables.read_good_data(spark, f"{out}/processed/good_data").collect(),
        "bad": tables.read_bad_data(spark, f"{out}/errors").collect(),
        "metadata": tables.read_metadata(spark, f"{out}/metadata").collect(),
    }


def _name(number, day=DAY):
    return f"store_{number}_{day}.csv"


@pytest.mark.parametrize(
    "number,total,good,bad,bad_rate,paid_rate,daily",
    [
        ("01", 3, 3, 0, 0.0, 0.3333, {"2024-02-01": 40.0, "2024-02-02": 60.0}),
        ("04", 6, 3, 3, 0.5, 0.6667, {"2024-02-06": 140.0}),
        ("08", 5, 0, 5, 1.0, 0.0, {}),
        ("10", 5, 2, 3, 0.6, 1.0, {"2024-02-13": 80.0}),
        ("11", 3, 3, 0, 0.0, 0.3333, {"2023-11-30": 21.0, "2023-12-02": 29.5}),
        ("13", 6, 1, 5, 0.8333, 1.0, {"2023-08-07": 13.5}),
        ("20", 2, 2, 0, 0.0, 0.5, {"2024-02-01": 20.0, "2024-02-02": 5.0}),
        ("22", 1, 1, 0, 0.0, 1.0, {"2024-02-01": 6.0}),
        ("23", 2, 1, 1, 0.5, 1.0, {"2024-02-01": 7.0}),
        ("26", 0, 0, 0, 0.0, 0.0, {}),
        ("27", 1, 1, 0, 0.0, 1.0, {"2024-02-01": 7.0}),
        ("28", 2, 1, 1, 0.5, 1.0, {"2024-02-01": 14.0}),
        ("40", 6, 1, 5, 0.8333, 1.0, {"2024-02-01": 1.0}),
        ("42", 5, 1, 4, 0.8, 1.0, {"2024-02-01": 2.0}),
        ("50", 2, 1, 1, 0.5, 1.0, {"2024-01-05": 1.0}),
        ("53", 2, 2, 0, 0.0, 1.0, {"2024-01-05": 2.0}),
        ("54", 1, 1, 0, 0.0, 1.0, {"2024-01-05": 1.0}),
        ("57", 2, 2, 0, 0.0, 1.0, {"2023-07-04": 3.0, "2023-11-28": 2.0}),
        ("80", 32, 31, 1, 0.0312, 1.0, {"2024-02-01": 31.0}),
    ],
)
def test_summary(run, number, total, good, bad, bad_rate, paid_rate, daily):
    name = _name(number)
    assert run["outcomes"][name]["status"] == "success"
    s = run["summaries"][name]
    assert (s.total_rows, s.good_rows, s.bad_rows) == (total, good, bad)
    assert (s.bad_row_rate, s.payment_success_rate) == (bad_rate, paid_rate)
    assert {d.order_date: d.daily_revenue for d in s.daily_revenue} == daily
    assert s.duration_ms > 0 and s.processed_at.endswith("+00:00")


@pytest.mark.parametrize(
    "name,error",
    [
        (_name("09"), "Schema validation failed: [\"Extra columns not allowed: ['promo_code', 'store_id']\"]"),
        (_name("12"), "Schema validation failed: [\"Missing columns: ['unit_price']\"]"),
        (_name("21"), OVERLONG),
        (_name("24"), OVERLONG),
        (_name("25"), OVERLONG),
        (_name("29"), UNDECODABLE),
        (_name("30"), "No columns to parse from file"),
        (_name("31"), "Schema validation failed: [\"Missing columns: ['order_id']\", "
                      "\"Extra columns not allowed: ['Order_id']\"]"),
        (_name("51"), "order_date cannot be read as a date in 1 good row(s)"),
        (_name("52"), MIXED_DATES),
        (_name("55"), "order_date cannot be read as a date in 1 good row(s)"),
        (_name("56"), "order_date cannot be read as a date in 1 good row(s)"),
        (f"shop_1_{DAY}.csv", f"Filename does not match store_{{id}}_{{YYYYMMDD}}.csv: 'shop_1_{DAY}.csv'"),
    ],
)
def test_refused(run, name, error):
    outcome = run["outcomes"][name]
    assert (outcome["status"], outcome["error"]) == ("error", error)
    assert name not in run["summaries"]


def test_refused_files_leave_no_rows(run):
    refused = {"09", "12", "21", "24", "25", "29", "30", "31", "51", "52", "55", "56"}
    for table in ("good", "bad", "metadata"):
        assert not refused & {r.store for r in run[table]}


def test_errors_of_rows(run):
    errors = {(r.store, r.order_id): r.validation_errors for r in run["bad"]}
    assert errors["08", "D4"] == "missing_unit_price;invalid_payment_status"
    assert errors["08", "D5"] == "missing_payment_status;invalid_payment_status"
    assert errors["08", "D2"] == "non_positive_unit_price"
    assert errors["10", "F1"] == "missing_customer_id"
    assert errors["10", "F2"] == "missing_product_id"
    assert errors["10", "F3"] == "missing_order_date"
    assert errors["13", "T1"] == "duplicate_row"
    assert errors["40", "A4"] == errors["40", "A5"] == "missing_customer_id"
    assert errors["40", "A6"] == "invalid_payment_status"
    assert errors["23", "A2"].split(";") == [
        "missing_payment_status", "missing_quantity", "missing_unit_price", "invalid_payment_status"]
    copies = sorted(r.validation_errors for r in run["bad"] if (r.store, r.order_id) == ("42", "A2"))
    assert copies == ["duplicate_row;missing_quantity", "missing_quantity", "missing_quantity"]
    assert [r.order_id for r in run["good"] if r.store == "40"] == ["none"]


def test_bad_rows_with_line_breaks_stay_whole(run):
    texts = [r.customer_id for r in run["bad"] if (r.store, r.order_id) == ("13", "T5")]
    assert texts == ['K\n"5", x']


def test_numbers(run):
    good = {r.order_id: r.quantity for r in run["good"] if r.store == "41"}
    assert good == {"A1": 3.0, "A2": 1000.0, "A6": float("inf")}
    bad = {r.order_id: r.validation_errors for r in run["bad"] if r.store == "41"}
    assert bad.pop("A9") == "non_positive_quantity"
    assert set(bad.values()) == {"missing_quantity"} and len(bad) == 6


def test_quoted_text_is_whole(run):
    assert [r.product_id for r in run["good"] if r.store == "28"] == ['P1\nlong, "name"']


def test_impossible_file_date_is_kept(run):
    assert [r.date for r in run["good"] if r.store == "60"] == ["2026-13-99"]


def test_upload_in_parts_is_one_file(run):
    s = run["summaries"][f"upload=store_70_{DAY}.csv"]
    assert (s.total_rows, s.good_rows) == (2, 1)


def test_parts_without_suffix_names_and_empty_uploads(run):
    assert run["summaries"][_name("71")].total_rows == 2
    assert run["outcomes"][_name("72")].source_key.endswith(f"/sub 1+2%/{_name('72')}")
    empty = run["outcomes"][_name("73")]
    assert (empty.status, empty.error, empty.store) == ("error", "No columns to parse from file", "73")
    assert not any("elsewhere" in o.source_key for o in run["outcomes"].values())


def test_outcomes_and_alerts_are_on_disk(run):
    written = {(o.source_key, o.status, o.error, o.run_id) for o in run["written"]["outcomes"]}
    assert written == {(o.source_key, o.status, o.error, "one") for o in run["outcomes"].values()}
    kinds = [a.event_type for a in run["written"]["alerts"]]
    failed = [o for o in run["outcomes"].values() if o.status == "error"]
    assert kinds.count("pipeline_failure") == len(failed)
    assert kinds.count("high_error_rate") == run["found"].high_error_alerts.count() > 0


def test_order_of_lists(run):
    s = run["summaries"][_name("11")]
    assert [(p.product_id, p.total_revenue) for p in s.top_products] == [("R1", 33.0), ("R4", 17.5)]
    [stored] = [m for m in run["metadata"] if m.store == "11"]
    assert [(c.customer_id, c.order_count) for c in stored.orders_per_customer] == [("K3", 2), ("K9", 1)]
    [bad_only] = [m for m in run["metadata"] if m.store == "08"]
    assert bad_only.orders_per_customer == []


def test_alerts(run):
    high = by_file(run["found"].high_error_alerts.collect())
    assert _name("81") in high and _name("80") not in high
    a = high[_name("81")]
    assert (a.event_type, a.source_bucket, a.bad_row_rate, a.threshold, a.bad_rows, a.total_rows) == (
        "high_error_rate", "landing", 0.2, 0.2, 1, 5)
    failed = by_file(run["found"].failure_alerts.collect())
    assert set(failed) == {n for n, o in run["outcomes"].items() if o["status"] == "error"}
    assert failed[_name("24")].event_type == "pipeline_failure"


def test_results_hold_summary_or_error(run):
    for r in run["found"].results().collect():
        assert (r.summary is None) == (r.status == "error") == (r.error is not None)


def test_written_files(run):
    out = run["out"]
    assert list((out / "processed/good_data/store=01/date=2026-04-18").rglob("*.snappy.parquet"))
    assert not (out / "processed/good_data/store=08").exists()
    assert not (out / "errors/store=01").exists()
    [errors] = (out / "errors/store=10/date=2026-04-18").rglob("*.csv")
    rows = list(csv.DictReader(errors.open(newline="")))
    assert list(rows[0]) == [*HEADER.split(","), "validation_errors"]
    assert sorted(r["customer_id"] for r in rows) == ["  ", "C2", "C3"]
    [summary] = (out / "metadata/store=11/date=2026-04-18").rglob("*.json")
    record = json.loads(summary.read_text())
    assert list(record) == [
        "source_key", "processed_at", "total_rows", "good_rows", "bad_rows", "bad_row_rate",
        "payment_success_rate", "daily_revenue", "top_products", "duration_ms"]
    [empty] = (out / "metadata/store=08/date=2026-04-18").rglob("*.json")
    assert json.loads(empty.read_text())["top_products"] == []


def test_metadata_reads_back(run):
    assert len(run["metadata"]) == sum(o["status"] == "success" for o in run["outcomes"].values())
    assert {r.store for r in run["metadata"]} >= {"01", "08", "26"}
