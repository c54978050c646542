"""Column expressions against Python's own answers."""

from __future__ import annotations

import math
from fractions import Fraction

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from storeledger.contract import NA_TOKENS, PYTHON_WHITESPACE
from storeledger.functions import (
    is_blank,
    na_to_null,
    order_day,
    order_day_layout,
    product_sum,
    python_list,
    python_repr,
    python_round,
    to_number,
    with_products,
)
from storeledger.sources import names
from storeledger.sources.landing import (
    _field_count,
    header_error,
    header_names,
    numbered_names,
)


def _apply(spark, values, expression, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i INT, v {kind}")
    out = rows.select("i", expression(F.col("v")).alias("r")).collect()
    return [r.r for r in sorted(out, key=lambda r: r.i)]


def test_python_round(spark):
    rates = sorted({a / b for b in (3, 32, 160, 800, 4000, 20000) for a in range(min(b, 400) + 1)})
    assert _apply(spark, rates, lambda v: python_round(v, 4), "double") == [round(r, 4) for r in rates]
    # The ties a decimal rounding gets wrong are among them.
    assert 3 / 20000 in rates and round(3 / 20000, 4) == 0.0001


def test_numbers(spark):
    cases = {
        "3": 3.0, " 3 ": 3.0, "\t3": 3.0, "+5": 5.0, "-5": -5.0, ".5": 0.5, "5.": 5.0, "1e3": 1000.0,
        "1E+3": 1000.0, "1e-400": 0.0, "00012": 12.0, "inf": math.inf, "-Infinity": -math.inf,
        "1,000": None, "1d": None, "1f": None, "1L": None, "0x10": None, "1_000": None, "1e": None,
        "e5": None, "1e400": None, "9" * 400: None, "٣": None, "True": None, "$5": None, "--5": None, ".": None,
        "-": None, "": None, " ": None, "1 000": None, "3\xa0": None, "infinit": None, "NaN": None,
    }
    assert dict(zip(cases, _apply(spark, list(cases), to_number))) == cases


def test_null_tokens(spark):
    kept = ["none", "Nan", "-", " ", " NA", "x"]
    rows = spark.createDataFrame([(t,) for t in [*NA_TOKENS, *kept]], "v STRING")
    assert [r.v for r in rows.select(na_to_null("v")).collect() if r.v is not None] == kept


def test_blank(spark):
    values = [*PYTHON_WHITESPACE, PYTHON_WHITESPACE, "", None, "x", "\xa0x", "\u200b", " . "]
    assert len(set(PYTHON_WHITESPACE)) == 29
    assert _apply(spark, values, is_blank) == [v is None or v.strip() == "" for v in values]


def test_order_days(spark):
    cases = {
        "2024-01-15": "2024-01-15", "2024-1-5": "2024-01-05", "2024/01/15": "2024-01-15",
        "2024-01-15 10:20:30": "2024-01-15", "2024-01-15T10:20": "2024-01-15",
        "2024-01-15T10:20:30.123Z": "2024-01-15", "2024-01-15 10:20+05:00": "2024-01-15",
        "1677-09-22": "1677-09-22", "2262-04-11": "2262-04-11", "2024-02-29": "2024-02-29",
        "1677-09-21": None, "2262-04-12": None, "2023-02-29": None, "2024-13-01": None, "20240115": None,
        "2024": None, "2024-01": None, "2024-01/15": None, "2024-01-15Z": None, "2024-01-15 25:00": None,
        " 2024-01-15": None, "15/01/2024": None, "": None, "now": None,
    }
    days = _apply(spark, list(cases), lambda v: order_day(v).cast("string"))
    assert dict(zip(cases, days)) == cases


def test_layouts_tell_formats_apart(spark):
    same = _apply(spark, ["2024-01-15", "2024-1-5", "1999-12-31"], order_day_layout)
    assert len(set(same)) == 1
    different = _apply(
        spark,
        ["2024-01-15", "2024/01/15", "2024-01-15 10:00", "2024-01-15T10:00", "2024-01-15 10:00:00",
         "2024-01-15 10:00:00.5", "2024-01-15 10:00Z", "2024-01-15 10:00+05:00", "2024-01-15 10:00+06:00"],
        order_day_layout,
    )
    assert len(set(different)) == 9


@settings(max_examples=1, deadline=None)
@given(st.lists(st.text("ab'\"\\\n\t, ", max_size=6), min_size=40, max_size=60))
def test_python_notation(spark, texts):
    assert _apply(spark, texts, python_repr) == [repr(t) for t in texts]
    listed = spark.createDataFrame([(texts,)], "v ARRAY<STRING>").select(python_list(F.col("v")))
    assert listed.first()[0] == repr(texts)


@pytest.mark.parametrize("parts", [1, 7])
def test_product_sum_is_exact(spark, parts):
    pairs = [(float(i % 50), round(0.01 + i * 1.37, 2)) for i in range(5000)]
    rows = spark.createDataFrame(pairs, "a DOUBLE, b DOUBLE").repartition(parts)
    exact = sum(Fraction(str(a)) * Fraction(str(b)) for a, b in pairs)
    assert with_products(rows, "a", "b").agg(product_sum()).first()[0] == float(exact)


def test_product_sum_of_other_values(spark):
    def total(pairs):
        return with_products(spark.createDataFrame(pairs, "a DOUBLE, b DOUBLE"), "a", "b").agg(product_sum()).first()[0]

    assert total([(1.0, math.inf), (1.0, 2.0)]) == math.inf
    assert total([(1.0, 1e-9), (1.0, 2.0)]) == pytest.approx(2.000000001, abs=1e-15)
    assert total([(1e200, 1e50)]) == pytest.approx(1e250)


def test_file_names(spark):
    cases = {
        "raw/store_01_20260418.csv": ("01", "2026-04-18"),
        "store_007_20261399.csv": ("007", "2026-13-99"),
        "upload=store_1_20240101.csv": ("1", "2024-01-01"),
        "raw/store_01_2026041.csv": (None, None),
        "raw/Store_01_20260418.csv": (None, None),
        "raw/store_01_20260418.csv.csv": (None, None),
        "raw/store__20260418.csv": (None, None),
    }
    keys = list(cases)
    found = zip(_apply(spark, keys, names.store_of), _apply(spark, keys, names.file_date_of))
    assert dict(zip(keys, found)) == cases
    errors = _apply(spark, keys, names.name_error)
    assert [e is None for e in errors] == [c[0] is not None for c in cases.values()]


def test_partition_of_accepted_names(spark):
    keys = ["raw/store_01_20260418.csv", "upload=store_007_20261399.csv", "a_b/c/store_1_20240101.csv"]
    rows = names.with_partition(spark.createDataFrame([(k,) for k in keys], "source_key STRING"))
    matched = rows.filter(
        (F.col("store") == names.store_of(F.col("source_key")))
        & (F.col("date") == names.file_date_of(F.col("source_key")))
    )
    assert matched.count() == 3


def test_uploads_and_keys(spark):
    paths = {
        "s3a://bucket/raw/store_1_20240101.csv": "raw/store_1_20240101.csv",
        "s3a://bucket/raw/upload=store_1_20240101.csv/part-0-x.csv": "raw/upload=store_1_20240101.csv",
        "file:///tmp/raw/store_1_20240101.csv/part-0.csv": "tmp/raw/store_1_20240101.csv",
        "file:/tmp/raw/store_1_20240101.csv": "tmp/raw/store_1_20240101.csv",
    }
    keys = _apply(spark, list(paths), lambda p: names.object_key(names.source_key(p)))
    assert dict(zip(paths, keys)) == paths


def test_header_names(spark):
    cases = {
        "a,b": ["a", "b"],
        '"a","b"': ["a", "b"],
        '"a,1","b""2"': ["a,1", 'b"2'],
        ",a,,b,": ["Unnamed: 0", "a", "Unnamed: 2", "b", "Unnamed: 4"],
        "a,b,a,a": ["a", "b", "a.1", "a.2"],
        " a,A": [" a", "A"],
    }
    headers = spark.createDataFrame(list(zip(cases, cases)), "file_path string, header string")
    named = headers.select("file_path", header_names(F.col("header")).alias("names"))
    assert {r.file_path: r.names for r in numbered_names(named).collect()} == cases


def test_header_error_lists_both(spark):
    text = _apply(spark, ["order_id,x,b"], lambda h: header_error(header_names(h)))[0]
    missing = "['customer_id', 'order_date', 'payment_status', 'product_id', 'quantity', 'unit_price']"
    assert text == "Schema validation failed: " + str(
        [f"Missing columns: {missing}", "Extra columns not allowed: ['b', 'x']"]
    )


def test_field_count(spark):
    cases = {"a": 1, "a,b": 2, "a,": 2, '"a,b",c': 2, '"a""b,c",d,': 3, 'a"b,c"': 2, "": 1, '"' + "x" * 20000 + ',",b': 2}
    assert _apply(spark, list(cases), _field_count) == list(cases.values())
