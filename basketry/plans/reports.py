"""Business reports as DataFrames. Values stay numeric; `functions.rules.display_*` formats them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.functions import rules
from basketry.functions.exact import cents, from_cents, mean_money, plain_ratio, rounded_mean
from basketry.operators.distribution import distinct_sorted, histogram, value_counts
from basketry.operators.ranking import quantiles
from basketry.plans.facts import completed_lines


def _completed() -> Column:
    return F.col("status") == "completed"


def _rows() -> Column:
    return F.count(F.lit(1))


def in_years(orders: DataFrame, years: Sequence[int] | None = None) -> DataFrame:
    """Orders of the chosen years; by default of every known year."""
    year = F.col("order_year")
    return orders.where(year.isNotNull() if years is None else year.isin(*years))


def year_choices(orders: DataFrame) -> DataFrame:
    return distinct_sorted(orders, "order_year")


def category_choices(products: DataFrame) -> DataFrame:
    return distinct_sorted(products, "category")


def segment_breakdown(metrics: DataFrame) -> DataFrame:
    return (
        metrics.where("rfm_segment IS NOT NULL")
        .groupBy("rfm_segment")
        .agg(
            _rows().alias("customers"),
            mean_money("monetary").alias("avg_spend"),
            rounded_mean(F.sum("recency_days"), F.count("recency_days"), 0, 1).alias("avg_recency_days"),
        )
        .orderBy(F.col("avg_spend").desc_nulls_last(), "rfm_segment")
    )


def top_revenue_months(facts: DataFrame, limit: int = 5) -> DataFrame:
    months = facts.where(_completed()).groupBy("order_year", "order_month")
    totals = months.agg(F.count("order_id").alias("orders"), F.sum("order_total").alias("revenue"))
    return totals.orderBy(F.col("revenue").desc_nulls_last(), "order_year", "order_month").limit(limit)


def category_revenue(items: DataFrame, products: DataFrame, orders: DataFrame) -> DataFrame:
    """Distinct completed orders, revenue and mean line value per category.

    Lines are first summed per order and category, so that the distinct count is a plain count and a category
    with most of the lines is spread over its orders.
    """
    per_order = (
        completed_lines(items, products, orders)
        .groupBy("category", "order_id")
        .agg(F.sum(cents(F.col("line_total"))).alias("_cents"), F.count("line_total").alias("_lines"))
    )
    total = F.sum(F.col("_cents").cast("decimal(20,0)"))
    return (
        per_order.groupBy("category")
        .agg(
            F.count("order_id").alias("num_orders"),
            from_cents(total).alias("total_revenue"),
            rounded_mean(total, F.sum("_lines"), 2, 2, wide=True).alias("avg_line_value"),
        )
        .orderBy(F.col("total_revenue").desc_nulls_last(), F.col("category").asc_nulls_last())
    )


def top_products(items: DataFrame, products: DataFrame, orders: DataFrame, limit: int = 20) -> DataFrame:
    """Best sellers by revenue; products sharing name, category and price count as one."""
    sold = (
        completed_lines(items, products, orders)
        .groupBy("product_name", "category", "price")
        .agg(F.count("item_id").alias("times_ordered"), F.sum("line_total").alias("total_revenue"))
    )
    names = [F.col(c).asc_nulls_last() for c in ("product_name", "category", "price")]
    top = sold.orderBy(F.col("total_revenue").desc_nulls_last(), *names).limit(limit)
    tier = rules.price_tier(F.col("price")).alias("price_tier")
    return top.select("product_name", "category", "price", tier, "times_ordered", "total_revenue")


def monthly_kpis(facts: DataFrame) -> DataFrame:
    return (
        facts.where(_completed())
        .groupBy("order_year", "order_month")
        .agg(
            F.count("order_id").alias("num_orders"),
            F.sum("order_total").alias("revenue"),
            F.count_distinct("customer_id").alias("unique_customers"),
        )
        .withColumn("period", rules.period_label(F.make_date("order_year", "order_month", F.lit(1))))
        .orderBy(F.col("order_year").asc_nulls_last(), F.col("order_month").asc_nulls_last())
    )


def monthly_revenue(facts: DataFrame) -> DataFrame:
    months = facts.where(_completed() & F.col("order_date").isNotNull())
    period = rules.period_label(F.col("order_date")).alias("period")
    return months.groupBy(period).agg(F.sum("order_total").alias("revenue")).orderBy("period")


def overview_kpis(facts: DataFrame, years: Sequence[int] | None = None) -> DataFrame:
    done = F.count_if(_completed())
    total = F.when(_completed(), F.col("order_total"))
    customer = F.when(_completed(), F.col("customer_id"))
    kpis = in_years(facts, years).agg(
        F.sum(total).alias("total_revenue"),
        done.alias("completed_orders"),
        plain_ratio(done, _rows(), 100).alias("completed_percent"),
        plain_ratio(F.sum(total), F.count(total)).alias("avg_order_value"),
        F.count_distinct(customer).alias("unique_customers"),
        plain_ratio(F.count_if(F.col("status") == "cancelled"), _rows(), 100).alias("cancel_percent"),
    )
    return kpis.withColumn("cancel_status", rules.cancel_status(F.col("cancel_percent")))


def status_breakdown(facts: DataFrame, years: Sequence[int] | None = None) -> DataFrame:
    return value_counts(in_years(facts, years), "status", "orders")


def weekday_revenue(facts: DataFrame, years: Sequence[int] | None = None) -> DataFrame:
    day = rules.dow_monday0(F.col("order_date")).alias("dow")
    days = in_years(facts, years).where(_completed() & F.col("order_date").isNotNull()).groupBy(day)
    sums = days.agg(F.sum("order_total").alias("revenue"))
    return sums.select("dow", rules.label_of(F.col("dow"), rules.WEEKDAYS).alias("day"), "revenue").orderBy("dow")


def product_kpis(products: DataFrame) -> DataFrame:
    active = F.count_if(F.col("is_active"))
    return products.agg(
        _rows().alias("products"),
        active.alias("active_products"),
        plain_ratio(active, _rows(), 100).alias("active_percent"),
        F.count_distinct("category").alias("categories"),
    )


def price_tier_distribution(products: DataFrame) -> DataFrame:
    return value_counts(products, "price_tier", "products")


def customer_kpis(customers: DataFrame) -> DataFrame:
    def of(segment: str) -> Column:
        return F.count_if(F.col("segment") == segment)

    return customers.agg(
        _rows().alias("customers"),
        of("VIP").alias("vip_customers"),
        of("At-Risk").alias("at_risk_customers"),
        plain_ratio(of("At-Risk"), _rows(), 100).alias("at_risk_percent"),
        of("New").alias("new_customers"),
    )


def customer_segment_distribution(customers: DataFrame) -> DataFrame:
    return value_counts(customers, "segment", "customers")


def rfm_distribution(metrics: DataFrame) -> DataFrame:
    return value_counts(metrics, "rfm_segment", "customers")


def recency_monetary_points(metrics: DataFrame) -> DataFrame:
    columns = ["customer_id", "rfm_segment", "recency_days", "monetary", "frequency", "rfm_score"]
    return metrics.where("rfm_segment IS NOT NULL").select(*columns)


def spend_histogram(metrics: DataFrame, bins: int = 40) -> DataFrame:
    return histogram(metrics, "monetary", bins, "customers")


FIVE_NUMBERS = {"minimum": 0.0, "q1": 0.25, "median": 0.5, "q3": 0.75, "maximum": 1.0}


def spread_by_segment(metrics: DataFrame, value: str, method: str = "selected") -> DataFrame:
    """Minimum, quartiles and maximum of a measure per RFM segment."""
    scored = metrics.where("rfm_segment IS NOT NULL")
    spread = quantiles(scored, "rfm_segment", value, FIVE_NUMBERS, method)
    return spread.withColumnRenamed("rows", "customers").orderBy("rfm_segment")


def run_statistics(orders: DataFrame) -> DataFrame:
    return orders.where(_completed()).agg(
        _rows().alias("total_orders"),
        F.sum("order_total").alias("total_revenue"),
        F.count_distinct("customer_id").alias("unique_customers"),
    )


def warehouse_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    counts = [df.agg(F.lit(name).alias("tbl"), _rows().alias("rows")) for name, df in tables.items()]
    return reduce(DataFrame.unionByName, counts)


def dedup_counts(raw: DataFrame, customers: DataFrame, any_copy: DataFrame) -> DataFrame:
    """Customer rows before and after removing copies, by both rules."""
    frames = {"raw": raw, "latest_per_key": customers, "any_per_key": any_copy}
    return warehouse_counts(frames).withColumnRenamed("tbl", "stage")


def ingest_profile(raw: Mapping[str, DataFrame]) -> DataFrame:
    """Ten checks on the raw tables, one row each (orders by status: one per status)."""
    wide = {
        "raw_customers": {
            "Total customers": _rows(),
            "Duplicate customers": _rows() - F.count_distinct("customer_id"),
            "Missing emails": F.count_if(F.col("email").isNull()),
        },
        "raw_orders": {
            "Total orders": _rows(),
            "Missing shipping city": F.count_if(F.col("shipping_city").isNull()),
            "Revenue (completed)": F.sum(F.when(_completed(), F.col("order_total"))),
        },
        "raw_order_items": {"Total order items": _rows()},
        "raw_events": {
            "Total events": _rows(),
            "Anonymous events": F.count_if(F.col("customer_id").isNull()),
        },
    }
    kind = "decimal(38,2)"
    nothing = F.lit(None).cast("string").alias("detail")
    frames = []
    for table, checks in wide.items():
        values = [value.cast(kind).alias(f"_{i}") for i, value in enumerate(checks.values())]
        rows = [
            F.struct(F.lit(name).alias("check_name"), nothing, F.col(f"_{i}").alias("value"))
            for i, name in enumerate(checks)
        ]
        frames.append(raw[table].agg(*values).select(F.inline(F.array(*rows))))
    by_status = raw["raw_orders"].groupBy(F.col("status").alias("detail")).agg(_rows().cast(kind).alias("value"))
    frames.append(by_status.select(F.lit("Orders by status").alias("check_name"), "detail", "value"))
    return reduce(DataFrame.unionByName, frames)
