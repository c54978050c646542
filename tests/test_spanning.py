"""Files with quoted line breaks, cut into many splits, against Spark's multi-line mode."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from storeledger.sources import landing
from tests.conftest import HEADER, store_file


def _multi_line(spark, path):
    schema = ", ".join(f"{p} STRING" for p in [*landing.POSITIONS, "_corrupt"])
    rows = (
        spark.read.schema(schema).option("header", True).option("quote", '"').option("escape", '"')
        .option("multiLine", True).option("columnNameOfCorruptRecord", "_corrupt").csv(str(path))
    )
    rows = rows.filter(F.col("_corrupt").isNull() | (F.trim(F.col("_corrupt")) != ""))
    return sorted((tuple(r[p] for p in landing.POSITIONS) for r in rows.collect()), key=repr)


def _split(spark, path, split):
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        zone = landing.Landing(str(path), dt.datetime.now(dt.timezone.utc) + dt.timedelta(days=1))
        files = zone.present(spark).select("file_path")
        parts = zone.lines(spark).rdd.getNumPartitions()
        rows = landing.spanning_rows(spark, zone, files).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    return parts, sorted((tuple(r[p] for p in landing.POSITIONS) for r in rows), key=repr)


def _field(draw):
    kind = draw.random()
    if kind < 0.5:
        return f"v{draw.randrange(1000)}"
    inner = draw.choice(["", "a", "x,y", 'say ""hi""', 'line\nbreak', '\n', '\n\n"",\n', 'é, "" \n end'])
    return f'"{inner}"'


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("seed", [1, 2])
def test_equals_multi_line_mode(spark, tmp_path, end, seed):
    draw = random.Random(seed)
    lines = [",".join(_field(draw) for _ in range(7)) for _ in range(120)]
    lines[5] = '5" pipe,b,c,d,1,2,paid'  # A quote inside a field that none opened.
    lines[40] = ""
    lines[41] = '"' + "long\n" * 200 + '",b,c,d,1,2,paid'  # Spans splits.
    path = store_file(tmp_path, "store_01_20260418.csv", *lines, end=end)
    parts, got = _split(spark, path, "400")
    assert parts > 10
    assert got == _multi_line(spark, path)
    assert len(got) == 119


def test_quoted_header_over_lines_and_no_rows(spark, tmp_path):
    header = '"order\nid",' + HEADER.partition(",")[2]
    path = store_file(tmp_path, "store_01_20260418.csv", 'a,"b\nc",d,e,1,2,paid', header=header)
    assert _split(spark, path, "30")[1] == _multi_line(spark, path)
    path = store_file(tmp_path, "store_02_20260418.csv", header=header)
    assert _split(spark, path, "30")[1] == []
