import pytest
from pyspark.sql import functions as F

import frames
from basketry.operators import quality
from basketry.operators.distribution import histogram, value_counts
from basketry.plans import reports, warehouse
from basketry.sources.tables import register


def test_histogram_closes_the_last_bin_and_keeps_empty_ones(spark):
    frame = spark.createDataFrame([(0.0,), (1.0,), (40.0,), (None,)], "v double")
    found = {r.bin: r.rows for r in histogram(frame, "v", 40).collect()}
    assert len(found) == 40 and {b: n for b, n in found.items() if n} == {1: 1, 2: 1, 40: 1}


def test_histogram_of_one_value(spark):
    frame = spark.createDataFrame([(5.0,), (5.0,)], "v double")
    rows = histogram(frame, "v", 4).collect()
    assert (rows[0].low, rows[-1].high) == (4.5, 5.5) and sum(r.rows for r in rows) == 2


def test_value_counts_skip_null_and_break_ties_by_value(spark):
    frame = spark.createDataFrame([("b",), ("a",), ("c",), ("c",), (None,)], "v string")
    assert [tuple(r) for r in value_counts(frame, "v").collect()] == [("c", 2, 0.5), ("a", 1, 0.25), ("b", 1, 0.25)]


def test_data_tests(spark):
    frame = spark.createDataFrame(
        [("1", "VIP"), ("1", "Gold"), ("2", None), (None, "New"), (None, "New")], "k string, s string"
    )
    tests = [
        quality.DataTest("m", "k", "unique"),
        quality.DataTest("m", "k", "not_null"),
        quality.DataTest("m", "s", "accepted_values", ("VIP", "New")),
    ]
    found = {r.test: (r.failures, r.passed) for r in quality.run_data_tests({"m": frame}, tests).collect()}
    assert found == {"unique": (1, False), "not_null": (2, False), "accepted_values": (1, False)}


def test_gate_names_every_failure(spark):
    orders = frames.orders(spark, (None, "1", "2024-01-01", "completed", "1"), ("b", "1", "2024-01-01", "x", "-1"))
    people = frames.customers(spark, ("1", "A", "B", None, "2024-01-01"))
    report = quality.gate_report({"raw_orders": orders, "raw_customers": people}, warehouse.expectations(2))
    with pytest.raises(quality.DataQualityError) as error:
        quality.assert_quality(report)
    for name in ("No null order IDs", "No negative revenue", "Customer count sanity"):
        assert name in str(error.value)
    good = quality.gate_report(
        {"raw_orders": orders.where(F.col("order_id").isNull() & F.lit(False)), "raw_customers": people},
        warehouse.expectations(1),
    )
    quality.assert_quality(good)
    assert good.count() == 3


def test_registered_tables_answer_sql(spark):
    schema = "rfm_segment string, monetary decimal(18,2), recency_days int"
    rows = [("Loyal", 10, 3), ("Loyal", 21, 4), ("Lost", 1, 9), (None, None, None)]
    metrics = spark.createDataFrame(rows, schema.replace("decimal(18,2)", "int"))
    metrics = metrics.withColumn("monetary", F.col("monetary").cast("decimal(18,2)"))
    register({"metrics_view": metrics})
    by_sql = spark.sql(
        """SELECT rfm_segment, count(*) AS customers, CAST(round(avg(monetary), 2) AS double) AS avg_spend,
             CAST(round(avg(recency_days), 1) AS double) AS avg_recency_days
           FROM metrics_view WHERE rfm_segment IS NOT NULL GROUP BY 1 ORDER BY 3 DESC"""
    )
    assert by_sql.collect() == reports.segment_breakdown(metrics).collect()
