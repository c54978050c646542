"""Samples are compared with their table without a shuffle of the table."""

from storeledger.plans import catalog


def test_sample_is_sought_in_the_table(spark):
    columns = "store string, quantity double"
    whole = spark.createDataFrame([("01", 1.0), ("01", 1.0), ("02", None), ("03", 2.0)], columns)
    sample = spark.createDataFrame(
        [("01", 1.0), ("01", 1.0), ("02", None), ("03", None), (None, 2.0)], columns
    )
    counted = catalog._sampled(sample, whole)
    assert [tuple(r) for r in counted.collect()] == [(5, 3)]
    # The table is cut to the sample's rows before its copies are folded.
    plan = counted._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join LeftSemi") == 2
    assert "rightHint=(strategy=broadcast)" in plan
