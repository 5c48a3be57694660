"""The supplied sample tables seen as the five raw tables.

Every raw column is one SQL expression, the same text for Spark and for the checking engine. The modulo
expressions plant the blanks and copies that cleaning has to deal with; no row is left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# raw table -> (sample table, {column: expression})
COLUMNS: dict[str, tuple[str, dict[str, str]]] = {
    "raw_customers": (
        "customer",
        {
            "customer_id": "c_custkey",
            "first_name": "case when c_custkey % 40 = 9 then null else substr(c_name,1,8) end",
            "last_name": "substr(c_name,10)",
            "email": "case when c_custkey % 50 = 7 then null else concat(substr(c_name,10),'@example.com') end",
            "city": "concat('City_',c_custkey % 100)",
            "state": "concat('S',c_nationkey)",
            "country": "'US'",
            "segment": "case c_mktsegment when 'AUTOMOBILE' then 'VIP' when 'HOUSEHOLD' then 'At-Risk' "
            "when 'MACHINERY' then 'New' else 'Regular' end",
            "signup_date": "date '1995-01-01' + cast(c_custkey % 1000 as int)",
            "age": "case when c_custkey % 20 = 3 then null else cast(18 + c_custkey % 53 as int) end",
        },
    ),
    "raw_products": (
        "part",
        {
            "product_id": "p_partkey",
            "product_name": "p_name",
            "category": "p_type",
            "price": "cast((cast(p_retailprice as decimal(18,2)) - 899) * 4 as decimal(18,2))",
            "cost": "cast(round(cast((cast(p_retailprice as decimal(18,2)) - 899) * 4 as decimal(18,2)) "
            "* cast(0.01 as decimal(3,2)) * (30 + p_size % 31),2) as decimal(18,2))",
            "stock_qty": "p_size*10",
            "is_active": "p_size % 10 <> 0",
        },
    ),
    "raw_orders": (
        "orders",
        {
            "order_id": "o_orderkey",
            "customer_id": "o_custkey",
            "order_date": "cast(o_orderdate as date)",
            "status": "case when o_orderstatus='F' then 'completed' when o_orderstatus='O' then 'pending' "
            "when o_orderkey % 3 = 0 then 'refunded' else 'cancelled' end",
            "order_total": "cast(o_totalprice as decimal(18,2))",
            "shipping_city": "case when o_orderkey % 33 = 5 then null else concat('City_',o_custkey % 100) end",
            "shipping_state": "case when o_orderkey % 37 = 6 then null else concat('S',o_custkey % 25) end",
        },
    ),
    "raw_order_items": (
        "lineitem",
        {
            "item_id": "l_orderkey*10+l_linenumber",
            "order_id": "l_orderkey",
            "product_id": "l_partkey",
            "quantity": "cast(l_quantity as int)",
            "unit_price": "cast(l_extendedprice as decimal(18,2))",
            "discount": "cast(l_discount as decimal(18,2))",
            "line_total": "cast(round(cast(l_extendedprice as decimal(18,2))"
            "*(1-cast(l_discount as decimal(18,2))),2) as decimal(18,2))",
        },
    ),
    "raw_events": (
        "events",
        {
            "event_id": "event_id",
            "customer_id": "case when event_type='error' then null else user_id end",
            "session_id": "concat('SESS_',user_id,'_',day(ts))",
            "event_type": "event_type",
            "product_id": "case when event_id % 10 < 3 then null else event_id % 200 end",
            "event_ts": "ts",
            "device": "case event_id % 3 when 0 then 'mobile' when 1 then 'desktop' else 'tablet' end",
            "os": "case event_id % 4 when 0 then 'iOS' when 1 then 'Android' when 2 then 'Windows' else 'macOS' end",
        },
    ),
}

# Copies added to raw_customers: (which customers, columns that differ from the original)
COPIES = (
    ("customer_id % 100 = 11", {}),
    ("customer_id % 100 = 12", {"city": "'Old'", "signup_date": "signup_date - 30"}),
)


def raw_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    sample, columns = COLUMNS[name]
    source = spark.read.parquet(f"{folder}/{sample}.parquet")
    df = source.selectExpr(*(f"{expression} as {column}" for column, expression in columns.items()))
    if name != "raw_customers":
        return df
    everyone = df
    for which, changed in COPIES:
        copies = df.where(which).selectExpr(*(f"{changed.get(c, c)} as {c}" for c in df.columns))
        everyone = everyone.unionAll(copies)
    return everyone


def raw_sql(name: str) -> str:
    """The same raw table as one SQL query over the sample tables."""
    sample, columns = COLUMNS[name]
    base = f"select {', '.join(f'{e} as {c}' for c, e in columns.items())} from {sample}"
    if name != "raw_customers":
        return base
    parts = ["select * from base"]
    for which, changed in COPIES:
        chosen = ", ".join(f"{changed[c]} as {c}" if c in changed else c for c in columns)
        parts.append(f"select {chosen} from base where {which}")
    return f"with base as ({base}) " + " union all ".join(parts)
