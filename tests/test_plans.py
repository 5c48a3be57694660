"""What the plans look like when tables are too large to broadcast and one key is very heavy."""

import contextlib

import pytest
from pyspark.sql import functions as F

from basketry.operators import ranking
from basketry.plans import facts, reports, rfm, staging
from basketry.sources.sample_tables import raw_table

FOLDER = "/root/testdata/sf0.001"
NO_BROADCAST = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
}
SMALL_SKEW = {
    **NO_BROADCAST,
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@contextlib.contextmanager
def settings(spark, values):
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def executed(df):
    """Rows and the plan as adaptive execution left it (only final plans mark a split join)."""
    rows = df.collect()
    return rows, df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def heavy(spark):
    """Sample orders and lines in which one product, one customer and one order hold a third of the rows."""
    orders = raw_table(spark, FOLDER, "raw_orders").repartition(8)
    items = raw_table(spark, FOLDER, "raw_order_items").repartition(8)
    hot = F.col("order_id") % 3 == 0
    orders = orders.withColumn("customer_id", F.when(hot, 7).otherwise(F.col("customer_id")))
    items = items.withColumn("product_id", F.when(F.col("item_id") % 3 == 0, 11).otherwise(F.col("product_id")))
    items = items.withColumn("order_id", F.when(F.col("item_id") % 3 == 1, 5).otherwise(F.col("order_id")))
    return orders.persist(), items.persist()


def products(spark):
    return staging.dim_products(raw_table(spark, FOLDER, "raw_products"))


def test_heavy_product_is_split_and_the_answer_stays(spark, heavy):
    orders, items = heavy
    build = lambda: facts.fct_orders(staging.stg_orders(orders), items, products(spark))
    plain = build().collect()
    with settings(spark, SMALL_SKEW):
        rows, plan = executed(build())
    assert "skew=true" in plan and "BroadcastHashJoin" not in plan
    assert sorted(map(str, rows)) == sorted(map(str, plain))


def test_heavy_order_in_category_revenue_is_split(spark, heavy):
    orders, items = heavy
    build = lambda: reports.category_revenue(items, products(spark), orders)
    plain = build().collect()
    with settings(spark, SMALL_SKEW):
        rows, plan = executed(build())
    assert "skew=true" in plan
    assert rows == plain


def test_heavy_customer_in_the_mart_is_split(spark, heavy):
    orders, items = heavy
    people = staging.dim_customers(raw_table(spark, FOLDER, "raw_customers"))
    build = lambda: facts.mart_orders(
        staging.stg_orders(orders), people, staging.stg_order_items(items), products(spark)
    )
    plain = build().collect()
    with settings(spark, SMALL_SKEW):
        rows, plan = executed(build())
    assert "skew=true" in plan
    assert sorted(map(str, rows)) == sorted(map(str, plain))


def test_orders_are_shuffled_once(spark):
    orders = raw_table(spark, FOLDER, "raw_orders")
    items = raw_table(spark, FOLDER, "raw_order_items")
    dims = products(spark)
    with settings(spark, {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}):
        plan = facts.fct_orders(staging.stg_orders(orders), items, dims)._jdf.queryExecution().executedPlan().toString()
    # Lines and products on product_id, summed lines and orders on order_id.
    assert plan.count("Exchange hashpartitioning") == 4


def test_reports_prune_what_they_do_not_show(spark):
    orders = raw_table(spark, FOLDER, "raw_orders")
    items = raw_table(spark, FOLDER, "raw_order_items")
    table = facts.fct_orders(staging.stg_orders(orders), items, products(spark))
    plan = reports.top_revenue_months(table)._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_set" not in plan and "discount" not in plan.split("Relation")[0]


def test_latest_row_is_reduced_before_the_shuffle(spark):
    raw = raw_table(spark, FOLDER, "raw_customers")
    plan = staging.dim_customers(raw)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2


def test_ranged_scores_pass_only_block_counts_through_one_task(spark):
    base = rfm.rfm_base(raw_table(spark, FOLDER, "raw_orders"))
    scored = rfm.rfm_score(base, method="ranged")
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan
    # The scalar subquery for the latest date is the one single-row exchange.
    assert plan.count("SinglePartition") <= 1


def test_top_products_use_a_bounded_heap(spark):
    raw = {n: raw_table(spark, FOLDER, f"raw_{n}") for n in ("order_items", "products", "orders")}
    plan = reports.top_products(*raw.values())._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_equal_values_spread_over_blocks(spark, monkeypatch):
    """Three quarters of the values are equal; no block may hold them all, and their filter moves no rows."""
    layouts = []
    lay_out = ranking.laid_out
    monkeypatch.setattr(ranking, "laid_out", lambda *a: layouts.append(lay_out(*a)) or layouts[-1])
    frame = spark.range(40000).selectExpr("'all' as g", "if(id % 4 = 0, id, 7) as v").repartition(8)
    with settings(spark, {"spark.sql.adaptive.coalescePartitions.enabled": "false"}):
        ranged = ranking.quantiles(frame, "g", "v", {"mid": 0.5, "hi": 0.99}, "ranged")
        window = ranking.quantiles(frame, "g", "v", {"mid": 0.5, "hi": 0.99}, "window")
        assert ranged.collect() == window.collect()
    sizes = [r["count"] for r in layouts[0].groupBy("_block").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 10000


def test_rows_at_ranks_are_found_without_moving_the_table(spark):
    laid = ranking.laid_out(spark.range(1000).selectExpr("id % 2 as g", "id"), [F.col("g"), F.col("id")])
    found = ranking.rows_at(laid, "g", lambda n: [F.lit(1), n])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert sorted(r.id for r in found.collect()) == [0, 1, 998, 999]


def test_stratified_marks_do_not_shuffle_the_rows_by_class(spark):
    frame = spark.range(1000).selectExpr("cast(id % 2 as int) as churned", "md5(cast(id as string)) as draw")
    marked = ranking.lowest_share(frame, "churned", ["draw"], (1, 5), "low", "ranged")
    plan = marked._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning(churned" not in plan and marked.where("low").count() == 200
