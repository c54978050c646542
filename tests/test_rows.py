"""Validation and metrics against a plain Python reading of the rules."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from storeledger.contract import ERROR_CODES, INPUT_COLUMNS
from storeledger.operators import metrics, summary, validate

ROW = ("O1", "C1", "P1", "2024-01-15", "2", "29.99", "paid")


def _raw(spark, rows):
    """rows: (file, seven texts)."""
    return spark.createDataFrame(rows, "source_key STRING, " + ", ".join(f"{c} STRING" for c in INPUT_COLUMNS))


def _random_rows(seed=7, n=1500):
    rng = random.Random(seed)

    def pick(*values):
        return rng.choice(values)

    rows = []
    for _ in range(n):
        rows.append((
            pick("f1", "f1", "f1", "f2", "f3"), pick("O1", "O2", "O3", " "), pick("C1", "C2", None),
            pick("P1", "P2", "P3"), pick("2024-01-15", "2024-01-16"), pick("1", "2", "1.0", "abc", "-1", "0", None),
            pick("10", "2.50", "NA", "0"), pick("paid", "PAID", "failed", "pending", "odd", "")))
    return rows


def _number(text):
    try:
        return float(text)
    except (TypeError, ValueError):
        return None


def _expected(rows):
    seen, out = Counter(), []
    for file, *fields in rows:
        fields = [None if f in (None, "", "NA") else f for f in fields]
        order, customer, product, day, q, p, status = fields
        quantity, price = _number(q), _number(p)
        key = (file, order, customer, product, day, quantity, q if quantity is None else None,
               price, p if price is None else None, status)
        codes = ["duplicate_row"] if seen[key] else []
        seen[key] += 1
        for name, value in zip(("order_id", "customer_id", "product_id", "order_date", "payment_status"),
                               (order, customer, product, day, status)):
            if value is None or not value.strip():
                codes.append(f"missing_{name}")
        for name, value in (("quantity", quantity), ("unit_price", price)):
            if value is None:
                codes.append(f"missing_{name}")
            elif value <= 0:
                codes.append(f"non_positive_{name}")
        if (status or "").lower() not in ("paid", "pending", "failed"):
            codes.append("invalid_payment_status")
        out.append((file, order, customer, product, day, quantity, price, status, ";".join(codes)))
    return out


@pytest.fixture(scope="module")
def sample(spark):
    rows = _random_rows()
    return validate.validate(_raw(spark, rows)).cache(), _expected(rows)


def _sorted(rows):
    return sorted((tuple(r) for r in rows), key=repr)


def test_every_row_and_its_errors(sample):
    validated, expected = sample
    assert _sorted(validate.validated_rows(validated).collect()) == _sorted(expected)
    assert _sorted(validate.bad_rows(validated).collect()) == _sorted(e for e in expected if e[-1])
    assert {c for e in expected for c in e[-1].split(";") if c} == set(ERROR_CODES) - {
        "missing_product_id", "missing_order_date"}


def test_hot_copies_are_spread_and_whole(sample, monkeypatch):
    validated, expected = sample
    monkeypatch.setattr(validate, "COPIES_PER_TASK", 2)
    assert _sorted(validate.bad_rows(validated).collect()) == _sorted(e for e in expected if e[-1])


def test_error_profile(sample):
    validated, expected = sample
    counts = Counter((e[0], c) for e in expected for c in e[-1].split(";") if c)
    got = {(r.source_key, r.code): r.rows for r in validate.error_profile(validated).collect()}
    assert got == dict(counts)


def test_copies_fold_before_the_shuffle(spark):
    """A third of all rows being one row leaves one row per input partition."""
    rows = _raw(spark, [("f", *ROW)] * 3000 + [("f", f"O{i}", *ROW[1:]) for i in range(2, 4000)])
    validated = validate.validate(rows.repartition(4))
    assert "Window" not in validated._jdf.queryExecution().executedPlan().toString()
    [hot] = validated.filter("copies > 1").collect()
    assert hot.copies == 3000
    counters = metrics.row_counters(validated).first()
    assert (counters.total_rows, counters.good_rows, counters.bad_rows) == (6998, 3999, 2999)


def test_metrics(sample):
    validated, expected = sample
    good = validate.good_rows(validated)
    daily, products, customers = defaultdict(float), defaultdict(float), defaultdict(set)
    for f, o, c, p, d, q, u, s, codes in expected:
        if not codes:
            daily[f, d] += q * u
            products[f, p] += q * u
            customers[f, c].add(o)
    assert {tuple(r)[:2]: r.daily_revenue for r in metrics.daily_revenue(good).collect()} == pytest.approx(dict(daily))
    assert {(r.source_key, r.product_id): r.total_revenue for r in metrics.top_products(good).collect()} == pytest.approx(dict(products))
    assert {tuple(r)[:2]: r.order_count for r in metrics.orders_per_customer(good).collect()} == {k: len(v) for k, v in customers.items()}
    for r in metrics.row_counters(validated).collect():
        mine = [e for e in expected if e[0] == r.source_key]
        ok = [e for e in mine if not e[-1]]
        paid = sum(e[7].lower() == "paid" for e in ok)
        assert (r.total_rows, r.good_rows, r.bad_rows) == (len(mine), len(ok), len(mine) - len(ok))
        assert r.bad_row_rate == round((len(mine) - len(ok)) / len(mine), 4)
        assert r.payment_success_rate == round(paid / len(ok), 4)


def test_top_ten_and_ties(spark):
    rows = [("f", f"O{i}", "C", f"P{i:02}", "2024-01-15", "1", str(10 + i // 2), "paid") for i in range(14)]
    top = metrics.top_products(validate.good_rows(validate.validate(_raw(spark, rows))))
    ranked = [r.product_id for r in sorted(top.collect(), key=lambda r: r.rank)]
    assert ranked == ["P12", "P13", "P10", "P11", "P08", "P09", "P06", "P07", "P04", "P05"]
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert plan.index("WindowGroupLimit") < plan.rindex("WindowGroupLimit")  # before and after the shuffle


def test_customer_lists_are_complete(spark):
    rows = [("f", f"O{i}", f"C{i % 100:03}", "P", "2024-01-15", "1", "1", "paid") for i in range(300)]
    rows += [("g", *ROW)]
    validated = validate.validate(_raw(spark, rows))
    records = summary.file_summary(validated, F.lit("-"), F.lit(1.005))
    whole = summary.with_customers(records, summary.customer_orders(validated)).collect()
    assert sorted(r.source_key for r in whole) == ["f", "g"]
    [f] = [r for r in whole if r.source_key == "f"]
    assert [tuple(c) for c in f.orders_per_customer] == [(f"C{i:03}", 3) for i in range(100)]
    assert f.duration_ms == round(1.005, 2)


def test_no_rows(spark):
    validated = validate.validate(_raw(spark, []))
    whole = metrics.overall_metrics(validated).first()
    assert (whole.total_rows, whole.bad_row_rate, whole.payment_success_rate, whole.revenue) == (0, 0.0, 0.0, 0.0)
