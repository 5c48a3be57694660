"""Rows at ranks by bracketed selection: brackets in use, narrowed, too small, and not able to part the rows."""

import math
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from basketry.operators import ranking, selection
from basketry.operators.ranking import lowest_share, ntiles, quantiles, running_totals


def wide(spark, rows=40_000):
    """Ties of a third, wide doubles with NaN and infinities, numbers that doubles confuse, texts with a common head, nulls."""
    n = F.col("id")
    return spark.range(rows).repartition(6).select(
        F.concat(F.lit("customer-"), F.lpad(n.cast("string"), 9, "0")).alias("k"),
        F.when(n % 3 == 0, 7).otherwise(n % 11).cast("int").alias("ties"),
        F.when(n % 97 == 0, F.lit(float("nan"))).when(n % 89 == 0, F.lit(-math.inf)).otherwise(F.sin(n) * 1e9).alias("double"),
        (F.lit(2**60) + F.xxhash64(n) % 40).alias("near"),
        F.when(n % 5 < 2, None).otherwise((F.hash(n) % 5000).cast("decimal(18,2)")).alias("money"),
        F.when(n % 2 == 0, F.md5(n.cast("string"))).otherwise("same head").alias("text"),
        F.date_add(F.lit("2020-01-01").cast("date"), (n % 700).cast("int")).alias("day"),
        F.lit(1).alias("one"),
    )


SCORES = {f"{c}_{up}": (c, up) for c in ("ties", "double", "near", "money", "day", "one") for up in (True, False)}


def same_tiles(frame, tiles=4, scores=SCORES):
    window, selected = (ntiles(frame, "k", scores, tiles, how) for how in ("window", "selected"))
    assert window.exceptAll(selected).isEmpty() and selected.count() == frame.count()


def test_tiles_of_every_kind_of_measure(spark):
    same_tiles(wide(spark))


@pytest.mark.parametrize("bound", [3_000, 200])
def test_kept_rows_are_narrowed_or_sorted_where_they_are_many(spark, monkeypatch, bound):
    sorts = []
    lay_out = ranking.laid_out
    monkeypatch.setattr(ranking, "laid_out", lambda *a: sorts.append(1) or lay_out(*a))
    monkeypatch.setattr(selection, "BOUND", bound)
    monkeypatch.setattr(selection, "FEW", 100)
    frame = wide(spark, 15_000)
    same_tiles(frame, 4, {"a": ("ties", True), "b": ("day", False)})
    assert not sorts
    same_tiles(frame, 3, {"c": ("near", True), "d": ("one", True)})
    assert sorts  # places cannot tell near numbers apart


def test_a_bracket_that_misses_its_rank_is_opened(spark, monkeypatch):
    monkeypatch.setattr(selection, "MARGIN", -0.01)
    frame = wide(spark, 12_000)
    same_tiles(frame, 4, {"a": ("double", True), "b": ("money", False)})
    group = frame.select((F.col("ties") % 2).alias("g"), "double").where("not isnan(double) and double > -1e300")
    points = {"q1": 0.25, "mid": 0.5}
    found, expected = (quantiles(group, "g", "double", points, how) for how in ("selected", "window"))
    assert sorted(found.collect()) == sorted(expected.collect())


@pytest.mark.parametrize("bound", [500_000, 50])
def test_quantiles_of_hot_and_small_groups(spark, monkeypatch, bound):
    monkeypatch.setattr(selection, "BOUND", bound)
    n = F.col("id")
    group = F.when(n % 3 == 0, "hot").when(n < 60, F.concat(F.lit("g"), (n % 20).cast("string"))).when(n % 7 == 0, None).otherwise("other")
    frame = spark.range(60_000).repartition(5).select(group.alias("g"), F.when(n % 4 == 0, 1.5).otherwise(F.cos(n)).alias("v"))
    points = {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.999, "e": 1.0}
    found, expected = (quantiles(frame, "g", "v", points, how) for how in ("selected", "window"))
    order = lambda r: (r.g is not None, r.g)
    for a, b in zip(sorted(found.collect(), key=order), sorted(expected.collect(), key=order), strict=True):
        assert (a.g, a.rows) == (b.g, b.rows) and tuple(a)[2:] == pytest.approx(tuple(b)[2:], abs=1e-12)


def test_lowest_share_by_texts_with_one_head(spark):
    frame = spark.range(30_000).select((F.col("id") % 3).alias("g"), F.concat(F.lit("same head "), F.md5(F.col("id").cast("string"))).alias("draw"))
    found, expected = (lowest_share(frame, "g", ["draw"], (1, 5), "low", how) for how in ("selected", "window"))
    assert found.exceptAll(expected).isEmpty() and found.where("low").count() == 6_000


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("abc"), st.one_of(st.none(), st.floats(-5, 5))), max_size=40))
def test_quantiles_of_small_tables(spark, rows):
    frame = spark.createDataFrame(rows, "g string, v double").repartition(3)
    points = {"lo": 0.0, "q": 0.3, "hi": 1.0}
    found, expected = ({r.g: tuple(r)[1:] for r in quantiles(frame, "g", "v", points, how).collect()} for how in ("selected", "window"))
    assert found.keys() == expected.keys() and all(found[g] == pytest.approx(expected[g]) for g in found)


def test_only_bracketed_rows_are_kept(spark, monkeypatch):
    sizes = []
    keep = selection.materialise
    monkeypatch.setattr(selection, "materialise", lambda df: sizes.append(keep(df)) or sizes[-1])
    frame = spark.range(200_000).select(F.col("id").alias("k"), F.xxhash64("id").alias("v"), F.rand(3).alias("w"))
    scored = ntiles(frame, "k", {"a": ("v", True), "b": ("w", False)})
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" not in plan and "Window" not in plan
    assert len(sizes) == 1 and sizes[0][1] < 200_000 * 6 * 5 * selection.MARGIN
    steps = quantiles(frame.withColumn("g", F.col("k") % 3), "g", "w", {"mid": 0.5})
    assert steps.count() == 3 and all(rows < 2_000 for _, rows in sizes[1:])


def test_running_totals_shuffle_once_and_stay_in_order(spark):
    numbers = list(range(500))
    random.Random(1).shuffle(numbers)
    frame = spark.createDataFrame([(i, None if i % 10 == 0 else i, "x") for i in numbers], "k int, n int, note string").repartition(7)
    laid = running_totals(frame, [F.desc("k")], {"upto": "n"})
    plan = laid._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan  # the sorted blocks are read where they lie
    total, found = 0, []
    for i in range(499, -1, -1):
        total += 0 if i % 10 == 0 else i
        found.append((i, None if i % 10 == 0 else i, "x", total))
    assert [tuple(r) for r in laid.collect()] == found


def test_brackets_are_found_by_a_short_expression_in_any_order_of_shares(spark, monkeypatch):
    frame = wide(spark).where("money IS NOT NULL").select("one", F.col("money").cast("double").alias("value"))
    ordered = sorted(r.value for r in frame.select("value").collect())
    shares = [0.9, *(i / 32 for i in range(1, 32)), 0.1]
    plans, kept = [], selection.materialise
    monkeypatch.setattr(selection, "materialise", lambda df: (plans.append(df._jdf.queryExecution().optimizedPlan().toString()), kept(df))[1])
    found = selection.values_at(frame, "one", ["value"], shares, lambda n: [F.ceil(n * F.lit(s)).cast("bigint") for s in shares]).first()
    assert [found[f"_v{i}"].value for i in range(len(shares))] == [ordered[math.ceil(len(ordered) * s) - 1] for s in shares]
    stepped = next(plan for plan in plans if "_step" in plan)
    assert stepped.count("_highs") < len(shares)
