from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import functions as F

import frames
from basketry.functions import rules
from basketry.operators.dedup import any_per_key
from basketry.plans import facts, reports, staging
from basketry.sources.schemas import RAW


def test_customers_keep_the_latest_signup_and_fill_blanks(spark):
    raw = frames.customers(
        spark,
        ("1", "Ann", "Lee", "a@x", "2024-01-01"),
        ("1", "Ann", "Lee", "a@x", "2024-01-01"),
        ("2", "Bob", "Ray", "old@x", "2024-01-01"),
        ("2", "Bob", "Ray", "new@x", "2024-02-01"),
        ("3", None, "Lee", None, "2024-01-01", "VIP", None),
        (None, "No", "Id", "n@x", "2024-01-01"),
    )
    found = {r.customer_id: r for r in staging.dim_customers(raw).collect()}
    assert set(found) == {"1", "2", "3"}
    assert found["2"].email == "new@x" and found["2"].signup_date == date(2024, 2, 1)
    assert (found["3"].full_name, found["3"].email, found["3"].age) == ("Lee", staging.UNKNOWN_EMAIL, 0)
    assert any_per_key(raw, ["customer_id"]).count() == 4
    custom = staging.dim_customers(raw, "none", 7).where("customer_id = '3'").first()
    assert (custom.email, custom.age) == ("none", 7)


def test_latest_row_does_not_depend_on_input_order(spark):
    rows = [("1", "Ann", "Lee", f"{i}@x", "2024-01-01") for i in range(50)]
    forward = staging.dim_customers(frames.customers(spark, *rows).repartition(7)).first()
    backward = staging.dim_customers(frames.customers(spark, *rows[::-1]).repartition(3)).first()
    assert forward == backward and forward.email == "0@x"


def test_products(spark):
    raw = frames.products(spark, ("p", "Books", "10", "4"), ("q", "Toys", "0", "4", False), (None, "Toys", "1", "1"))
    found = {r.product_id: r for r in staging.dim_products(raw).collect()}
    assert set(found) == {"p", "q"}
    assert found["p"].margin == Decimal("0.6") and found["p"].price_tier == "budget"
    assert found["q"].margin is None and found["q"].is_active is False


def test_orders_get_date_parts_and_places(spark):
    raw = frames.orders(spark, ("o", "1", "2024-01-07", "completed", "5", None, None), (None, "1", None, "x", "1"))
    (row,) = staging.stg_orders(raw).collect()
    assert (row.order_year, row.order_month, row.order_dow) == (2024, 1, 0)
    assert (row.shipping_city, row.shipping_state) == ("Unknown", "Unknown")
    assert staging.stg_orders(raw, rules.dow_sunday1).first().order_dow == 1


def test_items_without_id_are_dropped(spark):
    raw = frames.items(spark, ("i", "o", "p", 1, "2.50", "0.05", "2.38"), (None, "o", "p", 1, "1", "0", "1"))
    (row,) = staging.stg_order_items(raw).collect()
    assert row.net_price == Decimal("2.38")


def test_events_are_flagged_before_they_are_filled(spark):
    at = datetime(2024, 5, 1, 13, 45)
    rows = [("e1", None, "s", "view", None, at, "d", "o"), ("e2", "1", "s", "view", "p", at, "d", "o")]
    found = {r.event_id: r for r in staging.fct_events(spark.createDataFrame(rows, RAW["raw_events"])).collect()}
    assert (found["e1"].customer_id, found["e1"].is_anonymous, found["e1"].product_id) == ("ANONYMOUS", True, "NONE")
    assert (found["e2"].customer_id, found["e2"].is_anonymous, found["e2"].product_id) == ("1", False, "p")
    assert (found["e1"].event_date, found["e1"].event_hour) == (date(2024, 5, 1), 13)


def _shop(spark):
    orders = frames.orders(
        spark,
        ("o1", "1", "2024-01-07", "completed", "99"),
        ("o2", "1", "2024-01-08", "pending", "5"),
        ("o3", "9", "2024-01-09", "completed", "7"),
        ("o3", "9", "2024-01-09", "completed", "7"),
    )
    items = frames.items(
        spark,
        ("i1", "o1", "p", 1, "10", "0.10", "9.00"),
        ("i2", "o1", "q", 2, "10", "0.25", "15.00"),
        ("i3", "o1", "gone", 1, "1", "0.00", "1.00"),
        (None, "o1", "p", 1, "1", "0.00", "1.00"),
        ("i4", "o3", "p", 1, "10", "0.00", "10.00"),
        ("i5", "elsewhere", "p", 1, "10", "0.00", "10.00"),
        ("i6", None, "p", 1, "10", "0.00", "10.00"),
    )
    products = frames.products(spark, ("p", "Toys", "10", "4"), ("q", "Books", "3", "2"))
    return orders, items, products


def test_order_facts(spark):
    orders, items, products = _shop(spark)
    staged = staging.stg_orders(orders)
    found = {r.order_id: r for r in facts.fct_orders(staged, items, staging.dim_products(products)).collect()}
    assert len(found) == 3
    one = found["o1"]
    assert (one.order_total, one.num_items, one.categories_purchased) == (Decimal("26.00"), 3, ["Books", "Toys"])
    assert one.avg_discount == 0.0875
    assert one.avg_margin == round((0.6 + 0.3333 + 0.6) / 3, 4)
    two = found["o2"]
    assert (two.order_total, two.num_items, two.avg_discount, two.categories_purchased) == (None, 0, None, [])
    # An order copied twice meets its line twice.
    assert (found["o3"].order_total, found["o3"].num_items) == (Decimal("20.00"), 2)


def test_order_facts_match_grouping_the_joined_rows(spark):
    orders, items, products = _shop(spark)
    staged, dims = staging.stg_orders(orders), staging.dim_products(products)
    plain = (
        staged.join(items, "order_id", "left")
        .join(dims.select("product_id", "category", "margin"), "product_id", "left")
        .groupBy(*facts.ORDER_COLUMNS)
        .agg(F.sum("line_total").alias("order_total"), F.count("item_id").alias("num_items"))
    )
    ours = facts.fct_orders(staged, items, dims).select(*plain.columns)
    assert sorted(map(str, ours.collect())) == sorted(map(str, plain.collect()))


def test_unique_orders_shortcut_agrees(spark):
    orders, items, products = _shop(spark)
    staged = staging.stg_orders(orders.where("order_id <> 'o3'"))
    dims = staging.dim_products(products)
    slow = facts.fct_orders(staged, items, dims).collect()
    fast = facts.fct_orders(staged, items, dims, unique_orders=True).collect()
    assert sorted(map(str, slow)) == sorted(map(str, fast))


def test_mart_keeps_orders_of_unknown_customers(spark):
    orders, items, products = _shop(spark)
    people = staging.dim_customers(frames.customers(spark, ("1", "Ann", "Lee", None, "2024-01-01", "VIP")))
    mart = facts.mart_orders(
        staging.stg_orders(orders), people, staging.stg_order_items(items), staging.dim_products(products)
    )
    found = {r.order_id: r for r in mart.collect()}
    assert (found["o1"].customer_name, found["o1"].customer_segment) == ("Ann Lee", "VIP")
    assert found["o1"].order_total == Decimal("25.00")
    assert found["o3"].customer_name is None and found["o3"].order_total == Decimal("20.00")


def test_reconciliation_shows_the_two_revenues(spark):
    orders, items, _ = _shop(spark)
    found = {r.status: r for r in facts.revenue_reconciliation(orders.where("order_id <> 'o3'"), items).collect()}
    assert found["completed"].difference == Decimal("73.00") and found["completed"].orders_differing == 1
    assert found["pending"].lines_total == 0


def test_years_filter_and_default(spark):
    orders, items, products = _shop(spark)
    late = frames.orders(spark, ("o4", "1", "2025-03-01", "cancelled", "1"), ("o5", "1", None, "completed", "1"))
    table = facts.fct_orders(staging.stg_orders(orders.unionAll(late)), items, staging.dim_products(products))
    every = reports.overview_kpis(table).first()
    assert (every.completed_orders, every.cancel_percent, every.cancel_status) == (2, 25.0, "High")
    assert every.avg_order_value == 23.0 and every.unique_customers == 2
    assert reports.overview_kpis(table, [2025]).first().completed_orders == 0
    assert [r.order_year for r in reports.year_choices(table).collect()] == [2024, 2025]
    assert [(r.day, r.revenue) for r in reports.weekday_revenue(table).collect()] == [
        ("Tue", Decimal("20.00")),
        ("Sun", Decimal("26.00")),
    ]
