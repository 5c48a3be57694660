"""Small handmade frames in the raw schemas."""

from datetime import date
from decimal import Decimal

from basketry.sources.schemas import RAW


def money(text):
    return None if text is None else Decimal(text)


def day(text):
    return None if text is None else date.fromisoformat(text)


def customers(spark, *rows):
    """Rows of (id, first, last, email, signup[, segment[, age[, city]]])."""
    full = []
    for key, first, last, email, signup, *more in rows:
        segment, age, city = (*more, *("Regular", 30, "Rome")[len(more):])
        full.append((key, first, last, email, city, "S1", "US", segment, day(signup), age))
    return spark.createDataFrame(full, RAW["raw_customers"])


def products(spark, *rows):
    """Rows of (id, category, price, cost[, active])."""
    full = [
        (key, f"name {key}", category, money(price), money(cost), 5, more[0] if more else True)
        for key, category, price, cost, *more in rows
    ]
    return spark.createDataFrame(full, RAW["raw_products"])


def orders(spark, *rows):
    """Rows of (id, customer, date, status, total[, city[, state]])."""
    full = []
    for key, customer, when, status, total, *more in rows:
        city, state = (*more, *("Rome", "S1")[len(more):])
        full.append((key, customer, day(when), status, money(total), city, state))
    return spark.createDataFrame(full, RAW["raw_orders"])


def items(spark, *rows):
    """Rows of (item, order, product, quantity, price, discount, total)."""
    full = [(i, o, p, q, money(u), money(d), money(t)) for i, o, p, q, u, d, t in rows]
    return spark.createDataFrame(full, RAW["raw_order_items"])
