"""Business rules as column expressions. Thresholds and labels are arguments; the defaults are fixed values."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from basketry.functions.exact import MONEY, rounded_ratio

# Boundaries and labels the results depend on.
PRICE_TIERS = ((20, "budget"), (100, "mid"), (300, "premium"))
PRICE_TIER_ABOVE = "luxury"
RFM_SEGMENTS = ((10, "Champions"), (7, "Loyal"), (5, "At Risk"))
RFM_SEGMENT_BELOW = "Lost"
CHURN_RISKS = ((0.0, 0.3, "Low"), (0.3, 0.6, "Medium"), (0.6, 1.0, "High"))
CANCEL_STATUS = ((15.0, "High"), (8.0, "Watch"))
CHURN_STATUS = ((0.5, "High"), (0.3, "Moderate"))
WEEKDAYS = ("Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun")
CHURN_AFTER_DAYS = 180


def below(value: Column, steps: Sequence[tuple], otherwise: str) -> Column:
    """Label of the first step whose bound is above the value. NULL takes the last label, as in CASE."""
    first, *rest = steps
    chain = reduce(lambda c, s: c.when(value < s[0], s[1]), rest, F.when(value < first[0], first[1]))
    return chain.otherwise(otherwise)


def at_least(value: Column, steps: Sequence[tuple], otherwise: str) -> Column:
    """Label of the first step whose bound the value reaches; NULL stays NULL."""
    first, *rest = steps
    chain = reduce(lambda c, s: c.when(value >= s[0], s[1]), rest, F.when(value >= first[0], first[1]))
    return F.when(value.isNotNull(), chain.otherwise(otherwise))


def above(value: Column, steps: Sequence[tuple], otherwise: str) -> Column:
    """Label of the first step the value exceeds; NULL stays NULL."""
    first, *rest = steps
    chain = reduce(lambda c, s: c.when(value > s[0], s[1]), rest, F.when(value > first[0], first[1]))
    return F.when(value.isNotNull(), chain.otherwise(otherwise))


def price_tier(price: Column, tiers=PRICE_TIERS, top: str = PRICE_TIER_ABOVE) -> Column:
    return below(price, tiers, top)


def rfm_segment(score: Column, steps=RFM_SEGMENTS, rest: str = RFM_SEGMENT_BELOW) -> Column:
    return at_least(score, steps, rest)


def churn_risk(probability: Column, bins=CHURN_RISKS) -> Column:
    """Right-closed bins; a probability of exactly 0 falls in none and gives NULL."""
    (lo, hi, label), *rest = bins
    inside = F.when((probability > lo) & (probability <= hi), label)
    return reduce(lambda c, b: c.when((probability > b[0]) & (probability <= b[1]), b[2]), rest, inside)


def cancel_status(percent: Column) -> Column:
    return above(percent, CANCEL_STATUS, "Healthy")


def churn_status(probability: Column) -> Column:
    return above(probability, CHURN_STATUS, "Low")


def error_status(mae: Column, good: float = 10000.0, fair: float = 25000.0) -> Column:
    return F.when(
        mae.isNotNull(),
        F.when(mae < good, "Accurate").when(mae < fair, "Moderate").otherwise("Review model"),
    )


def label_of(code: Column, labels: Sequence[str], first: int = 0) -> Column:
    """Look a small integer code up in a list of labels; unknown codes give NULL."""
    return F.get(F.array(*map(F.lit, labels)), code - F.lit(first))


def churned(recency_days: Column, days: int = CHURN_AFTER_DAYS) -> Column:
    return (recency_days >= days).cast("int")


def full_name(first: Column, last: Column) -> Column:
    """Missing parts are skipped."""
    return F.concat_ws(" ", first, last)


def full_name_or_null(first: Column, last: Column) -> Column:
    """NULL as soon as one part is missing."""
    return F.concat(first, F.lit(" "), last)


def dow_sunday1(day: Column) -> Column:
    """Sunday is 1, Saturday 7."""
    return F.dayofweek(day)


def dow_sunday0(day: Column) -> Column:
    """Sunday is 0, Saturday 6."""
    return F.dayofweek(day) - F.lit(1)


def dow_monday0(day: Column) -> Column:
    """Monday is 0, Sunday 6."""
    return F.weekday(day)


def margin(price: Column, cost: Column, digits: int = 4) -> Column:
    """Share of the price left after cost, as an exact decimal; NULL when the price is 0."""
    places = F.lit(10**digits).cast("decimal(14,0)")
    return (rounded_ratio(price - cost, price, digits) / places).cast(f"decimal(18,{digits})")


def net_price(unit_price: Column, discount: Column) -> Column:
    return F.round(unit_price - unit_price * discount, 2).cast(MONEY)


def line_total(quantity: Column, unit_price: Column, discount: Column) -> Column:
    return F.round(quantity * unit_price * (F.lit(1) - discount), 2).cast(MONEY)


def period_label(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def month_wave(month: Column) -> tuple[Column, Column]:
    """Sine and cosine of the month's place in the year."""
    angle = F.lit(2.0) * F.pi() * month / F.lit(12.0)
    return F.sin(angle), F.cos(angle)


def display_money(value: Column) -> Column:
    return F.concat(F.lit("$"), F.format_number(value, 2))


def display_percent(fraction: Column) -> Column:
    return F.concat(F.format_number(fraction * 100, 1), F.lit("%"))


def display_change(percent: Column) -> Column:
    return F.concat(F.when(percent >= 0, "+").otherwise(""), F.format_number(percent, 1), F.lit("%"))
