"""What keeps the jobs' cost in step with their input: plans and generated code."""

import contextlib
import datetime as dt
import io
import re

from pyspark.sql import functions as F

from storeledger.contract import INPUT_COLUMNS, PYTHON_WHITESPACE
from storeledger.functions import is_blank
from storeledger.operators import validate
from storeledger.sources import landing, names

# Methods with more bytes of code are left to the JVM's interpreter.
COMPILED_BYTES = 8000


def _plan(frame) -> str:
    return frame._jdf.queryExecution().optimizedPlan().toString()


def test_scan_and_fold_of_uploads_are_compiled(spark, tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()
    rows = "\n".join(f"{i},c{i},p{i},2024-01-0{i},1,2.50,paid" for i in range(1, 9))
    (folder / "store_01_20240101.csv").write_text(f"{landing.USUAL_HEADER}\n{rows}\n")
    zone = landing.Landing(str(folder), dt.datetime.now(dt.timezone.utc) + dt.timedelta(hours=1))
    raw = landing.raw_rows(spark, zone, landing.file_verdicts(spark, zone))
    folded = validate.validate(raw, carry_max=("overlong",), staged=True)
    assert folded.count() == 8
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # Else no code is shown.
    try:
        shown = io.StringIO()
        with contextlib.redirect_stdout(shown):
            folded.explain("codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", shown.getvalue())]
    assert sizes and max(sizes) <= COMPILED_BYTES


def _validated(spark, staged):
    texts = ", ".join(f"{c} string" for c in INPUT_COLUMNS)
    good = ("f", "1", "c", "p", "2024-01-01", "1", "2", "paid")
    rows = [good, good, ("f", "2", " ", "p", "2024-01-01", "x", "2", "paid")]
    raw = spark.createDataFrame(rows, f"source_key string, {texts}")
    return validate.validate(raw, staged=staged)


def test_mask_of_a_staged_fold_is_not_shuffled_and_no_filter_moves_before_others(spark):
    for staged in (True, False):
        found = _validated(spark, staged)
        assert sorted((r.order_id, r.copies, r.error_mask) for r in found.collect()) == [
            ("1", 2, 0),
            ("2", 1, validate._bit("missing_customer_id") | validate._bit("missing_quantity")),
        ]
        assert ("max(error_mask" in _plan(found)) is not staged
        assert validate.good_rows(found).count() == 1
    good = _plan(validate.good_rows(_validated(spark, False)))
    assert good.index("Filter") < good.index("Aggregate")


def test_blank_texts(spark):
    blanks = [None, "", *PYTHON_WHITESPACE, PYTHON_WHITESPACE]
    texts = ["!", "~", "a ", " a", "\x00", "\x7f", "\x80", "\xe9", "​", "一", " ​"]
    frame = spark.createDataFrame([(t,) for t in blanks + texts], "t string")
    found = frame.select("t", is_blank(F.col("t")).alias("blank")).collect()
    assert [r.t for r in found if not r.blank] == texts
    assert [r.t for r in found if r.blank] == blanks


def test_upload_of_a_path(spark):
    uploads = {
        "/a/b.csv": "/a/b.csv",
        "/a/b.csv/part-1": "/a/b.csv",
        "/a/b.csv/part-": "/a/b.csv",
        "/a/b.csv/part-1/c.txt": "/a/b.csv/part-1/c.txt",
        "/a/b.csv/part-1.csv/part-2": "/a/b.csv/part-1.csv",
        "b.csv/part-1": "b.csv",
        "/a/é +.csv/part-é": "/a/é +.csv",
    }
    frame = spark.createDataFrame([(p,) for p in uploads], "p string")
    found = frame.select("p", names.source_key(F.col("p")).alias("u")).collect()
    assert {r.p: r.u for r in found} == uploads
    paths = {"/a+b/c.csv": "/a+b/c.csv", "/a%20b+%25.csv": "/a b+%.csv"}
    frame = spark.createDataFrame([(p,) for p in paths], "p string")
    found = frame.select("p", names.decoded(F.col("p")).alias("d")).collect()
    assert {r.p: r.d for r in found} == paths
