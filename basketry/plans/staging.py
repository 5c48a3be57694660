"""Raw tables to clean tables. All but the customer table are plain projections."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.functions import rules
from basketry.operators.dedup import latest_per_key

UNKNOWN_EMAIL = "unknown@example.com"
UNKNOWN_PLACE = "Unknown"
ANONYMOUS = "ANONYMOUS"
NO_PRODUCT = "NONE"


def dim_customers(
    raw: DataFrame,
    default_email: str = UNKNOWN_EMAIL,
    default_age: int = 0,
    name: Callable[[Column, Column], Column] = rules.full_name,
) -> DataFrame:
    """One row per customer, the latest signup; rows without an id are dropped."""
    latest = latest_per_key(raw.where("customer_id IS NOT NULL"), ["customer_id"], "signup_date")
    return latest.select(
        "customer_id",
        name(F.col("first_name"), F.col("last_name")).alias("full_name"),
        "first_name",
        "last_name",
        F.coalesce("email", F.lit(default_email)).alias("email"),
        "city",
        "state",
        "country",
        "segment",
        F.to_date("signup_date").alias("signup_date"),
        F.coalesce(F.col("age").cast("int"), F.lit(default_age)).alias("age"),
    )


def dim_products(raw: DataFrame, tiers=rules.PRICE_TIERS, top_tier: str = rules.PRICE_TIER_ABOVE) -> DataFrame:
    price, cost = F.col("price"), F.col("cost")
    return raw.where("product_id IS NOT NULL").select(
        "product_id",
        "product_name",
        "category",
        "price",
        "cost",
        rules.margin(price, cost).alias("margin"),
        rules.price_tier(price, tiers, top_tier).alias("price_tier"),
        "stock_qty",
        F.col("is_active").cast("boolean").alias("is_active"),
    )


def stg_orders(
    raw: DataFrame,
    weekday: Callable[[Column], Column] = rules.dow_sunday0,
    default_place: str = UNKNOWN_PLACE,
) -> DataFrame:
    """Orders with an id, their date parts, and placeholders for missing shipping places."""
    day = F.to_date("order_date")
    return raw.where("order_id IS NOT NULL").select(
        "order_id",
        "customer_id",
        day.alias("order_date"),
        "status",
        "order_total",
        F.coalesce("shipping_city", F.lit(default_place)).alias("shipping_city"),
        F.coalesce("shipping_state", F.lit(default_place)).alias("shipping_state"),
        F.year(day).alias("order_year"),
        F.month(day).alias("order_month"),
        weekday(day).alias("order_dow"),
    )


def stg_order_items(raw: DataFrame) -> DataFrame:
    net = rules.net_price(F.col("unit_price"), F.col("discount"))
    return raw.where("item_id IS NOT NULL").select(
        "item_id", "order_id", "product_id", "quantity", "unit_price", "discount", "line_total", net.alias("net_price")
    )


def fct_events(raw: DataFrame, anonymous: str = ANONYMOUS, no_product: str = NO_PRODUCT) -> DataFrame:
    """Events with date, hour and a flag for missing customers, set before the ids are filled.

    Works on a batch or a streaming DataFrame.
    """
    at = F.col("event_ts").cast("timestamp_ntz")
    return raw.select(
        "event_id",
        F.coalesce(F.col("customer_id").cast("string"), F.lit(anonymous)).alias("customer_id"),
        "session_id",
        "event_type",
        F.coalesce(F.col("product_id").cast("string"), F.lit(no_product)).alias("product_id"),
        at.alias("event_ts"),
        "device",
        "os",
        F.to_date(at).alias("event_date"),
        F.hour(at).alias("event_hour"),
        F.col("customer_id").isNull().alias("is_anonymous"),
    )
