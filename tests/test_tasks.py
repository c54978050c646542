"""Large jobs run in tasks of bounded size, and what is shuffled or staged is kept short."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from conftest import store_file
from storeledger import session
from storeledger.plans import catalog, ingest
from storeledger.session import bounded_tasks
from storeledger.sources import workload


def _sizes(spark):
    return [session._bytes(spark.conf.get(name)) for name in session._TASK_SIZES]


def test_tasks_are_bounded_inside_the_block_only(spark):
    before = _sizes(spark)
    assert all(size > session.TASK_BYTES for size in before)
    with pytest.raises(AnalysisException), bounded_tasks(spark):
        assert _sizes(spark) == [session.TASK_BYTES] * 2
        with bounded_tasks(spark):
            spark.table("no_such_table")
    assert _sizes(spark) == before
    name = session._TASK_SIZES[1]
    set_before = spark.conf.get(name)
    spark.conf.set(name, "1m")
    try:
        with bounded_tasks(spark):
            assert _sizes(spark) == [session.TASK_BYTES, 1 << 20]
        assert spark.conf.get(name) == "1m"
    finally:
        spark.conf.set(name, set_before)


def test_sizes():
    sizes = {"64MB": 64 << 20, "134217728b": 128 << 20, "3": 3, "2g": 2 << 30, " 5k ": 5 << 10}
    assert {text: session._bytes(text) for text in sizes} == sizes


def test_ingest_and_kept_tables_are_written_by_bounded_tasks(spark, tmp_path, monkeypatch):
    seen, stage = {}, ingest.stage

    def staged(df, name):
        seen[name] = _sizes(spark)
        return stage(df, name)

    monkeypatch.setattr(ingest, "stage", staged)
    store_file(tmp_path / "in", "store_01_20240101.csv", "1,c,p,2024-01-01,1,2.50,paid")
    ingest.ingest(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    path = catalog._kept(
        spark, str(tmp_path), "sizes", lambda p: seen.update({p: _sizes(spark)})
    )
    assert {"validated", "customers", "superseded", path} <= set(seen)
    assert set(map(tuple, seen.values())) == {(session.TASK_BYTES,) * 2}


LINES = "l_orderkey long, l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double, l_shipdate timestamp_ntz"
ORDERS = "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz, o_orderstatus string"


def _tables(spark, folder, lines):
    at = F.lit("1998-03-04 05:06:07").cast("timestamp_ntz")
    rows = spark.createDataFrame(lines, LINES.rpartition(",")[0]).withColumn("l_shipdate", at)
    rows.write.parquet(f"{folder}/lineitem.parquet")
    orders = spark.createDataFrame([(i, 10 + i, "F") for i in range(1, 5)], "o_orderkey long, o_custkey long, o_orderstatus string")
    orders.withColumn("o_orderdate", at).write.parquet(f"{folder}/orders.parquet")
    return str(folder)


def test_columns_are_short_before_the_join_and_fail_as_before(spark, tmp_path):
    lines = [(1, 7, 21, 3.9, 12.345), (2, 8, None, None, None), (None, 9, 3, 1.0, 1.0)]
    # Out of range, but nothing asks for it: no order, or a rule that needs no number.
    lines += [(99, 9, 3, 1e300, 1e300)]
    where = _tables(spark, tmp_path / "a", lines)
    rows = workload.sales_rows(spark, where, "YEAR")
    got = sorted((r.order_id, r.quantity, r.unit_price, r.store, r.date, r.order_date) for r in rows.collect())
    assert got == [
        ("1", "3", "12.35", "01", "1998-01-01", "1998-03-04"),
        ("2", None, None, None, "1998-01-01", "1998-03-04"),
    ]
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.index("Join") :]
    assert "decimal(18,2)" in below and "trunc" in below
    too_large = workload.sales_rows(spark, _tables(spark, tmp_path / "b", [(1, 7, 21, 1.0, 1e300)]))
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE"):
        too_large.collect()


def test_most_landing_rows_are_not_staged(spark, tmp_path, monkeypatch):
    staged, stage = {}, workload.stage

    def counted(df, name):
        staged[name] = df.count()
        return stage(df, name)

    monkeypatch.setattr(workload, "stage", counted)
    lines = [(1, p, p, 1.0, 2.0) for p in range(20)]
    root = str(tmp_path / "zone")
    workload.write_landing_zone(spark, _tables(spark, tmp_path / "t", lines), root)
    assert staged == {"landing-rows": len(workload.HEADER_OF_STORE)}
    text = spark.read.option("recursiveFileLookup", True).text(root)
    rows = text.filter("value rlike '[0-9]'").count()
    assert rows == 20
