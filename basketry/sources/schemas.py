"""Schemas of the five raw tables."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _I, _M, _B = T.StringType(), T.IntegerType(), T.DecimalType(18, 2), T.BooleanType()


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


RAW = {
    "raw_customers": _schema(
        ("customer_id", _S),
        ("first_name", _S),
        ("last_name", _S),
        ("email", _S),
        ("city", _S),
        ("state", _S),
        ("country", _S),
        ("segment", _S),
        ("signup_date", T.DateType()),
        ("age", _I),
    ),
    "raw_products": _schema(
        ("product_id", _S),
        ("product_name", _S),
        ("category", _S),
        ("price", _M),
        ("cost", _M),
        ("stock_qty", _I),
        ("is_active", _B),
    ),
    "raw_orders": _schema(
        ("order_id", _S),
        ("customer_id", _S),
        ("order_date", T.DateType()),
        ("status", _S),
        ("order_total", _M),
        ("shipping_city", _S),
        ("shipping_state", _S),
    ),
    "raw_order_items": _schema(
        ("item_id", _S),
        ("order_id", _S),
        ("product_id", _S),
        ("quantity", _I),
        ("unit_price", _M),
        ("discount", _M),
        ("line_total", _M),
    ),
    "raw_events": _schema(
        ("event_id", _S),
        ("customer_id", _S),
        ("session_id", _S),
        ("event_type", _S),
        ("product_id", _S),
        ("event_ts", T.TimestampNTZType()),
        ("device", _S),
        ("os", _S),
    ),
}

# The file each raw table comes from.
CSV_FILES = {
    "raw_customers": "customers.csv",
    "raw_products": "products.csv",
    "raw_orders": "orders.csv",
    "raw_order_items": "order_items.csv",
    "raw_events": "events.csv",
}
