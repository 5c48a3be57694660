"""Totals kept by difference against full builds, and sets of customers against distinct counts."""

import random

import pytest
from pyspark.sql import functions as F

import frames
from basketry.operators import distinct, quality
from basketry.plans import facts, maintenance, reports, staging
from basketry.sources.sample_tables import raw_table

FOLDER = "/root/testdata/sf0.001"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def shop(spark):
    products = staging.dim_products(frames.products(spark, *((i, f"c{i % 4}" if i % 5 else None, f"{3 + i}.50", f"{i}.25") for i in range(1, 12))))
    orders = staging.stg_orders(frames.orders(spark, *((f"o{i}", f"{i % 7}", f"2024-0{1 + i % 9}-03", "completed", "5") for i in range(40))))
    return products, orders


def some_lines(pick, many):
    made = []
    for _ in range(many):
        price = f"{pick.randint(1, 90)}.{pick.randint(10, 99)}"
        made.append((pick.choice([None, pick.randint(1, 10**6)]), pick.choice([None, *(f"o{i}" for i in range(45))]), pick.choice([99, *range(1, 12)]), 1, price, pick.choice([None, "0.10", "0.05"]), price))
    return made


@pytest.mark.parametrize("seed", [1, 2])
def test_changes_give_what_a_full_build_gives(spark, shop, tmp_path, seed):
    products, orders = shop
    pick = random.Random(seed)
    kept = some_lines(pick, 120)
    totals = maintenance.LineTotals(spark, str(tmp_path / "t"), buckets=8)
    totals.rebuild(frames.items(spark, *kept), products)
    for turn in range(3):
        gone = pick.sample(range(len(kept)), 25)
        deleted, new = [kept[i] for i in gone], some_lines(pick, 10 + turn)
        changed = [(*line[:4], "7.77", "0.01", "7.77") for line in deleted[:8]]  # old value away, new value in
        totals.apply(frames.items(spark, *new, *changed), frames.items(spark, *deleted), products)
        kept = [line for i, line in enumerate(kept) if i not in set(gone)] + new + changed
        full = facts.fct_orders(orders, frames.items(spark, *kept), products)
        found = maintenance.order_facts(orders, totals.state())
        assert found.columns == full.columns and rows(found) == rows(full)
    assert rows(totals.state().select("order_id")) == sorted({(line[1],) for line in kept if line[1]}, key=repr)


def test_only_touched_buckets_are_written(spark, shop, tmp_path):
    products, _ = shop
    totals = maintenance.LineTotals(spark, str(tmp_path / "t"), buckets=16)
    lines = [(i, f"o{i}", 1, 1, "5.00", None, "5.00") for i in range(40)]
    totals.rebuild(frames.items(spark, *lines), products)
    before = totals.table._list(1)["partitions"]
    touched = totals.apply(frames.items(spark, (100, "o3", 2, 1, "1.00", None, "1.00")), frames.items(spark), products)
    after = totals.table._list(2)["partitions"]
    assert len(touched) == 1 and [p for p in before if before[p] != after[p]] == [f"bucket={touched[0]}"]
    assert totals.apply(frames.items(spark), frames.items(spark), products) == [] and totals.table.versions() == [1, 2]
    alone = [line for line in lines if f"bucket={touched[0]}" and line[1] == "o3"]
    totals.apply(frames.items(spark), frames.items(spark, *lines, (100, "o3", 2, 1, "1.00", None, "1.00")), products)
    assert alone and totals.state().count() == 0 and totals.table._list(3)["partitions"] == {}


def test_a_change_is_one_grouping_and_products_are_joined_once(spark, shop, tmp_path, monkeypatch):
    products, _ = shop
    totals = maintenance.LineTotals(spark, str(tmp_path / "t"), buckets=4)
    lines = [(i, f"o{i % 9}", 1 + i % 11, 1, "5.00", None, "5.00") for i in range(60)]
    totals.rebuild(frames.items(spark, *lines[:40]), products)
    plans, write = [], totals.table.write
    monkeypatch.setattr(totals.table, "write", lambda df, *a, **k: (plans.append(df._jdf.queryExecution().optimizedPlan().toString()), write(df, *a, **k))[1])
    totals.apply(frames.items(spark, *lines[40:]), frames.items(spark, *lines[:10]), products)
    (plan,) = plans
    assert plan.count("Aggregate ") == 1 and plan.count("Join ") == 1 and "collect_list" not in plan
    expected = maintenance.LineTotals(spark, str(tmp_path / "whole"), buckets=4)
    expected.rebuild(frames.items(spark, *lines[10:]), products)
    found = [df.withColumn("categories", F.sort_array("categories")) for df in (totals.state(), expected.state())]
    assert rows(found[0]) == rows(found[1])


def test_sets_unite_to_distinct_counts(spark):
    n = F.col("id")
    table = spark.range(20_000).select((n % 7).alias("g"), (n % 3).alias("h"), F.when(n % 11 > 0, F.xxhash64(n) % 90_000).alias("x"))
    sets = distinct.distinct_sets(table, ["g", "h"], F.col("x")).cache()
    for groups in (["g", "h"], ["g"], ["h"], []):
        expected = table.groupBy(*groups).agg(F.count_distinct("x").alias("distinct"))
        assert rows(distinct.sizes(sets, groups)) == rows(expected)
    assert distinct.sizes(sets.limit(0), []).first()[0] == 0


def test_any_choice_of_years_is_a_union(spark):
    orders = raw_table(spark, FOLDER, "raw_orders")
    staged = staging.stg_orders(orders)
    table = facts.fct_orders(staged, raw_table(spark, FOLDER, "raw_order_items"), staging.dim_products(raw_table(spark, FOLDER, "raw_products")))
    sets = maintenance.monthly_customers(table).cache()
    months = maintenance.customers_in(sets, groups=["order_year", "order_month"])
    assert rows(months) == rows(reports.monthly_kpis(table).select("order_year", "order_month", "unique_customers"))
    for years in ((1996, 1998), (1992,), (1800,), None):
        assert maintenance.customers_in(sets, years).first()[0] == reports.overview_kpis(table, years).first().unique_customers
    plan = maintenance.customers_in(sets, (1996,))._jdf.queryExecution().optimizedPlan().toString()
    assert "InMemoryRelation" in plan and "Join" not in plan.split("InMemoryRelation")[0]


def test_dense_numbers_follow_the_order(spark):
    frame = spark.createDataFrame([("b",), ("a",), (None,), ("b",), ("ä",), ("",)], "id string").repartition(4)
    assert rows(distinct.dense_numbers(frame, "id")) == [("", 1), ("a", 2), ("b", 3), ("ä", 4)]


def test_repeats_are_found_by_ranges(spark):
    clean = spark.range(200_000).select(F.when(F.col("id") % 1000 > 0, F.col("id") - 100_000).alias("k"))
    assert quality.duplicate_keys(clean, "k").isEmpty()
    dirty = clean.unionByName(spark.createDataFrame([(5,), (5,), (-70_000 - 1,), (None,)], "k long"))
    assert rows(quality.duplicate_keys(dirty, "k")) == [(-70_001, 2), (5, 3)]
    apart = spark.range(3_000).select((F.col("id") % 2_999 * 2**50).alias("k"))
    assert rows(quality.duplicate_keys(apart, "k")) == [(0, 2)]
    assert quality.duplicate_keys(clean.limit(0), "k").isEmpty()
    texts = spark.createDataFrame([("a",), ("a",), ("b",)], "k string")
    assert rows(quality.duplicate_keys(texts, "k")) == [("a", 2)]
