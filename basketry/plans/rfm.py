"""Recency, frequency and monetary value per customer, their quartile scores and segments."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.functions import rules
from basketry.functions.exact import cents, from_cents
from basketry.operators.ranking import ntiles

MEASURES = ("recency_days", "frequency", "monetary")
SCORES = ("r_score", "f_score", "m_score")


def rfm_base(orders: DataFrame, status: str = "completed") -> DataFrame:
    """Per customer over completed orders; recency counts from the latest order of any status.

    The latest date is a scalar subquery over one column. The grouping combines on the map side, so a customer
    with very many orders reaches the shuffle as one row per task.
    """
    day = F.to_date("order_date")
    last = orders.agg(F.max(day)).scalar()
    return (
        orders.where(F.col("status") == status)
        .groupBy("customer_id")
        .agg(
            F.datediff(last, F.max(day)).alias("recency_days"),
            F.count("order_id").alias("frequency"),
            from_cents(F.sum(cents(F.col("order_total")))).alias("monetary"),
            F.min(day).alias("first_order_date"),
            F.max(day).alias("last_order_date"),
        )
    )


def rfm_score(
    base: DataFrame,
    recency_ascending: bool = False,
    method: str = "selected",
    steps=rules.RFM_SEGMENTS,
    rest: str = rules.RFM_SEGMENT_BELOW,
) -> DataFrame:
    """Scores 1 to 4 per measure, their sum and the segment.

    The recency score is NTILE over recency descending or, with `recency_ascending`, 5 minus NTILE over
    recency ascending; they differ when the row count is no multiple of four.
    """
    scores = {"r_score": ("recency_days", recency_ascending), "f_score": ("frequency", True), "m_score": ("monetary", True)}
    scored = ntiles(base, "customer_id", scores, 4, method)
    if recency_ascending:
        scored = scored.withColumn("r_score", F.lit(5) - F.col("r_score"))
    summed = scored.withColumn("rfm_score", F.col("r_score") + F.col("f_score") + F.col("m_score"))
    return summed.withColumn("rfm_segment", rules.rfm_segment(F.col("rfm_score"), steps, rest))


def customer_metrics(customers: DataFrame, scored: DataFrame, how: str = "left") -> DataFrame:
    """Customers with their scores: 'left' keeps customers without a completed order, 'inner' drops them.

    Both sides hold one row per customer, so no key is heavy.
    """
    return customers.join(scored, "customer_id", how)
