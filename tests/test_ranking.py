import random
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import frames
from basketry.operators.ranking import lowest_share, ntiles, quantiles, running_totals
from basketry.plans import rfm, staging

METHODS = ["window", "ranged", "selected"]


def expected_tiles(rows, tiles, ascending):
    """Tile per key for (key, value) rows, NULL values last, ties by key."""
    def order(row):
        key, value = row
        return (value is None, 0 if value is None else (value if ascending else -value), key)

    n, found = len(rows), {}
    size, extra = divmod(n, tiles)
    for i, (key, _) in enumerate(sorted(rows, key=order)):
        big = extra * (size + 1)
        found[key] = i // (size + 1) + 1 if i < big else extra + (i - big) // size + 1
    return found


@pytest.mark.parametrize("method", METHODS)
@pytest.mark.parametrize("n", [0, 1, 2, 3, 4, 5, 7, 10, 23])
def test_ntiles_match_the_definition(spark, method, n):
    rng = random.Random(n)
    rows = [(f"c{i:03d}", rng.choice([None, 1, 1, 1, 2, 5])) for i in range(n)]
    frame = spark.createDataFrame(rows, "k string, v int")
    found = ntiles(frame, "k", {"up": ("v", True), "down": ("v", False)}, 4, method).collect()
    assert {r.k: r.up for r in found} == expected_tiles(rows, 4, True)
    assert {r.k: r.down for r in found} == expected_tiles(rows, 4, False)


def test_ranged_ntiles_equal_the_window_on_heavy_ties(spark):
    """A third of the rows share one value; the tie-break alone decides where the tiles end."""
    frame = spark.range(30000).select(
        F.concat(F.lit("c"), F.col("id")).alias("k"),
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 11).cast("bigint").alias("v"),
        (F.hash("id") % 1000).cast("decimal(18,2)").alias("m"),
    )
    scores = {"a": ("v", True), "b": ("v", False), "c": ("m", True)}
    window, ranged, selected = (ntiles(frame, "k", scores, 4, how) for how in METHODS)
    assert window.exceptAll(ranged).isEmpty() and ranged.count() == 30000
    assert window.exceptAll(selected).isEmpty() and selected.count() == 30000
    sizes = {r["a"]: r["count"] for r in ranged.groupBy("a").count().collect()}
    assert sizes == {1: 7500, 2: 7500, 3: 7500, 4: 7500}


def test_one_plan_ranks_each_measure_in_its_own_type(spark):
    big = F.lit(2**60) + F.col("id") % 500  # doubles cannot tell these apart
    frame = spark.range(1000).select(F.col("id").alias("k"), big.alias("v"), (F.col("id") % 7 / 3.0).alias("w"))
    scores = {"a": ("v", True), "b": ("v", False), "c": ("w", False)}
    ranged, window = ntiles(frame, "k", scores), ntiles(frame, "k", scores, method="window")
    assert "Window" not in ranged._jdf.queryExecution().optimizedPlan().toString()
    assert ranged.exceptAll(window).isEmpty() and ranged.count() == 1000
    for method in ("fast", "auto"):
        with pytest.raises(ValueError):
            ntiles(frame, "k", scores, method=method)


@pytest.mark.parametrize("method", METHODS)
def test_quantiles_interpolate(spark, method):
    rows = [("a", float(v)) for v in (1, 2, 3, 10)] + [("b", 5.0), ("c", None)] + [(None, 1.0), (None, 2.0)]
    frame = spark.createDataFrame(rows, "g string, v double")
    points = {"lo": 0.0, "q1": 0.25, "mid": 0.5, "hi": 1.0}
    found = {r.g: tuple(r)[1:] for r in quantiles(frame, "g", "v", points, method).collect()}
    assert found == {"a": (4, 1.0, 1.75, 2.5, 10.0), "b": (1, 5.0, 5.0, 5.0, 5.0), None: (2, 1.0, 1.25, 1.5, 2.0)}


@pytest.mark.parametrize("method", METHODS)
def test_lowest_share_per_group(spark, method):
    rows = [("a", i) for i in range(10)] + [("b", i) for i in range(3)] + [("c", 1), ("c", 2)]
    frame = spark.createDataFrame(rows, "g string, v int").repartition(4)
    found = lowest_share(frame, "g", ["v"], (1, 5), "low", method)
    low = {(r.g, r.v) for r in found.collect() if r.low}
    assert low == {("a", 0), ("a", 1), ("b", 0)} and found.count() == 15


@settings(max_examples=5, deadline=None)
@given(st.lists(st.integers(-5, 5), min_size=0, max_size=60))
def test_running_totals(spark, numbers):
    frame = spark.createDataFrame(list(enumerate(numbers)), "k int, x int").repartition(5)
    expected, total = {}, 0
    for key, number in enumerate(numbers):
        total += number
        expected[key] = total
    for method in METHODS:
        found = running_totals(frame, [F.col("k")], {"s": "x"}, method).collect()
        assert {r.k: r.s for r in found} == expected


def test_recency_forms_differ_when_rows_do_not_divide(spark):
    rows = [(str(i), i, 1, Decimal(1)) for i in range(10)]
    base = spark.createDataFrame(rows, "customer_id string, recency_days int, frequency bigint, monetary decimal(18,2)")

    def scores(**how):
        return [r.r_score for r in rfm.rfm_score(base, **how).orderBy("recency_days").collect()]

    for method in METHODS:
        # Ten rows make tiles of 3, 3, 2 and 2, filled from the oldest.
        assert scores(method=method) == [4, 4, 3, 3, 2, 2, 2, 1, 1, 1]
        assert scores(method=method, recency_ascending=True) == [4, 4, 4, 3, 3, 3, 2, 2, 1, 1]


def test_equal_frequencies_are_split_by_customer(spark):
    rows = [(str(i), i, 1, Decimal(1)) for i in range(8)]
    base = spark.createDataFrame(rows, "customer_id string, recency_days int, frequency bigint, monetary decimal(18,2)")
    for method in METHODS:
        scored = rfm.rfm_score(base, method=method).orderBy("customer_id").collect()
        assert [r.f_score for r in scored] == [1, 1, 2, 2, 3, 3, 4, 4]


def test_rfm_base_counts_recency_from_any_status(spark):
    orders = frames.orders(
        spark,
        ("a", "1", "2024-01-01", "completed", "10.10"),
        ("b", "1", "2024-01-05", "completed", "0.05"),
        ("c", "2", "2024-01-15", "cancelled", "3"),
        ("d", None, "2024-01-02", "completed", "4"),
    )
    found = {r.customer_id: r for r in rfm.rfm_base(orders).collect()}
    assert set(found) == {"1", None}
    one = found["1"]
    assert (one.recency_days, one.frequency, one.monetary) == (10, 2, Decimal("10.15"))
    people = staging.dim_customers(
        frames.customers(spark, ("1", "A", "B", None, "2024-01-01"), ("2", "C", "D", None, "2024-01-01"))
    )
    for method in METHODS:
        scored = rfm.rfm_score(rfm.rfm_base(orders), method=method)
        left = {r.customer_id: r for r in rfm.customer_metrics(people, scored).collect()}
        assert left["2"].rfm_segment is None and left["2"].r_score is None
        inner = rfm.customer_metrics(people, scored, "inner").collect()
        assert [r.customer_id for r in inner] == ["1"]
