"""Order facts.

Lines are summed per order before they meet the orders, so the fan-out is never grouped on ten columns and
the orders are shuffled once, on order_id. The products are joined without a hint: Spark broadcasts them only
when their measured size is under its threshold and otherwise shuffles, splitting a product that holds too
many lines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.functions import rules
from basketry.functions.exact import cents, from_cents, rounded_mean, rounded_ratio, units
from basketry.operators.quality import duplicate_keys

ORDER_COLUMNS = (
    "order_id",
    "customer_id",
    "order_date",
    "order_year",
    "order_month",
    "order_dow",
    "status",
    "shipping_city",
    "shipping_state",
)
_MARGIN_PLACES, _RAW_MARGIN_PLACES = 4, 12


def lines_per_order(items: DataFrame, products: DataFrame, raw_margin: bool = False) -> DataFrame:
    """Totals, means and category set of the lines of each order.

    The mean margin is taken over margins rounded to four places, or over the unrounded ratios (held to
    twelve places) with `raw_margin`.
    """
    if raw_margin:
        places = _RAW_MARGIN_PLACES
        margin = rounded_ratio(F.col("price") - F.col("cost"), F.col("price"), places)
    else:
        places = _MARGIN_PLACES
        margin = units(F.col("margin"), places)
    priced = products.select("product_id", "category", margin.alias("_margin"))
    grouped = (
        items.where("order_id IS NOT NULL")
        .select(
            "order_id",
            "product_id",
            "item_id",
            cents(F.col("line_total")).alias("_cents"),
            cents(F.col("discount")).alias("_discount"),
        )
        .join(priced, "product_id", "left")
        .groupBy("order_id")
        .agg(
            F.sum("_cents").alias("_cents"),
            F.count("item_id").alias("_lines"),
            F.sum("_discount").alias("_discounts"),
            F.count("_discount").alias("_discounted"),
            F.sum("_margin").alias("_margins"),
            F.count("_margin").alias("_margined"),
            F.sort_array(F.collect_set("category")).alias("_categories"),
        )
    )
    return grouped.select(
        F.col("order_id").alias("_order"),
        from_cents(F.col("_cents")).alias("_total"),
        "_lines",
        rounded_mean(F.col("_discounts"), F.col("_discounted"), 2, 4).alias("avg_discount"),
        rounded_mean(F.col("_margins"), F.col("_margined"), places, 4, wide=raw_margin).alias("avg_margin"),
        F.col("_categories").alias("categories_purchased"),
    )


def _per_distinct_order(joined: DataFrame, keys: list[str]) -> DataFrame:
    """One row per distinct order; identical copies count the lines once each.

    The line columns are the same in every copy, so any one will do, and unused ones are pruned.
    """
    kept = [F.first(c).alias(c) for c in joined.columns if c not in keys]
    grouped = joined.groupBy(*keys).agg(F.count(F.lit(1)).alias("_copies"), *kept)
    return grouped.withColumns(
        {
            "_total": (F.col("_total") * F.col("_copies")).cast("decimal(28,2)"),
            "_lines": F.col("_lines") * F.col("_copies"),
        }
    )


def has_unique_orders(orders: DataFrame) -> bool:
    """Whether no order id repeats; shuffles the ids only."""
    return duplicate_keys(orders, "order_id").isEmpty()


def fct_orders(
    orders: DataFrame,
    items: DataFrame,
    products: DataFrame,
    raw_margin: bool = False,
    unique_orders: bool = False,
    customers: DataFrame | None = None,
) -> DataFrame:
    """One row per distinct order with the totals of its lines; orders without lines are kept.

    `orders` comes from `stg_orders`, `products` from `dim_products`. Identical copies of an order become one
    row that counts the lines once per copy, as grouping the joined rows would. The grouping reuses the
    partitioning of the join; `unique_orders=True`, safe where `has_unique_orders` holds, skips it.
    """
    lines = lines_per_order(items, products, raw_margin)
    keys, extra = list(ORDER_COLUMNS), []
    done = orders.select(*keys).join(lines, F.col("order_id") == F.col("_order"), "left").drop("_order")
    if not unique_orders:
        done = _per_distinct_order(done, keys)
    if customers is not None:
        extra = [F.col("full_name").alias("customer_name"), F.col("segment").alias("customer_segment")]
        done = done.join(customers.select("customer_id", "full_name", "segment"), "customer_id", "left")
    return done.select(
        *keys,
        *extra,
        F.col("_total").alias("order_total"),
        F.coalesce("_lines", F.lit(0).cast("bigint")).alias("num_items"),
        "avg_discount",
        "avg_margin",
        F.coalesce("categories_purchased", F.array().cast("array<string>")).alias("categories_purchased"),
    )


def mart_orders(
    orders: DataFrame, customers: DataFrame, items: DataFrame, products: DataFrame, unique_orders: bool = False
) -> DataFrame:
    """Order facts with the customer's name and segment. All four inputs are staged tables."""
    wide = fct_orders(orders, items, products, unique_orders=unique_orders, customers=customers)
    return wide.drop("order_dow", "categories_purchased")


def completed_lines(
    items: DataFrame, products: DataFrame, orders: DataFrame, status: str = "completed"
) -> DataFrame:
    """Lines of orders with one status, with their product's columns.

    The orders come first, as they drop lines; a broadcast of the products then keeps the partitioning on
    order_id for whatever is grouped next.
    """
    wanted = orders.where(F.col("status") == status).select(F.col("order_id").alias("_order"))
    sold = products.select(F.col("product_id").alias("_product"), "product_name", "category", "price")
    return (
        items.join(wanted, F.col("order_id") == F.col("_order"))
        .join(sold, F.col("product_id") == F.col("_product"))
        .drop("_order", "_product")
    )


def revenue_reconciliation(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Per status: the orders' own totals against the sums of their lines."""
    lines = (
        items.where("order_id IS NOT NULL")
        .groupBy(F.col("order_id").alias("_order"))
        .agg(from_cents(F.sum(cents(F.col("line_total")))).alias("_lines"))
    )
    both = orders.join(lines, F.col("order_id") == F.col("_order"), "left")
    differs = ~F.coalesce("order_total", F.lit(0)).eqNullSafe(F.coalesce("_lines", F.lit(0)))
    header, total = F.coalesce(F.sum("order_total"), F.lit(0)), F.coalesce(F.sum("_lines"), F.lit(0))
    return (
        both.groupBy("status")
        .agg(
            F.count(F.lit(1)).alias("orders"),
            header.alias("header_total"),
            total.alias("lines_total"),
            (header - total).alias("difference"),
            F.count_if(differs).alias("orders_differing"),
        )
        .orderBy(F.col("status").asc_nulls_last())
    )


def weekday_forms(orders: DataFrame) -> DataFrame:
    """Each order's weekday in the three numberings in use."""
    day = F.col("order_date")
    return orders.select(
        "order_id",
        rules.dow_sunday1(day).alias("dow_sunday1"),
        rules.dow_sunday0(day).alias("dow_sunday0"),
        rules.dow_monday0(day).alias("dow_monday0"),
    )
