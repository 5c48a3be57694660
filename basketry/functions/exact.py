"""Exact decimal rounding.

Money is DECIMAL(18,2) everywhere. A mean or ratio is rounded half up on whole numbers, so the result does
not depend on the order in which partial sums arrive, and becomes a double only at the end.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"
WIDE = "decimal(38,0)"


def units(value: Column, scale: int, wide: bool = False) -> Column:
    """A decimal with `scale` places as a whole number of 10**-scale."""
    return (value * F.lit(10**scale)).cast(WIDE if wide else "bigint")


def cents(money: Column) -> Column:
    """A money value as a whole number of cents.

    Summing bigints keeps a grouping on many keys in primitive buffers, which DECIMAL(28,2) sums leave. The
    double detour is exact for values up to 9e12; larger ones take the decimal way.
    """
    limit = F.lit(Decimal("9000000000000.00"))
    near = money.between(-limit, limit)
    return F.when(near, F.rint(money.cast("double") * F.lit(100.0)).cast("bigint")).otherwise(units(money, 2))


def from_cents(total: Column) -> Column:
    return (total.cast("decimal(26,0)") * F.lit(Decimal("0.01"))).cast("decimal(28,2)")


def half_up(numerator: Column, denominator: Column, shift: int) -> Column:
    """`numerator * 10**shift / denominator`, rounded half away from zero to a whole number.

    Both are whole numbers (bigint, or DECIMAL(38,0) where twice the scaled numerator may pass 2**63).
    NULL when the denominator is zero.
    """
    up, down = F.lit(10 ** max(shift, 0)), F.lit(10 ** max(-shift, 0))
    divisor = F.abs(denominator) * down
    size = F.call_function("div", F.abs(numerator) * up * F.lit(2) + divisor, divisor * F.lit(2))
    signed = F.when((numerator < 0) != (denominator < 0), -size).otherwise(size)
    return F.when(denominator != 0, signed)


def rounded_mean(total: Column, count: Column, scale: int, digits: int, wide: bool = False) -> Column:
    """Mean of `count` values summing to `total` units of 10**-scale, half up to `digits`, as a double."""
    if wide:
        total, count = total.cast(WIDE), count.cast(WIDE)
    return half_up(total, count, digits - scale).cast("double") / F.lit(10.0**digits)


def mean_money(column: str, digits: int = 2) -> Column:
    """Aggregate: exact mean of a money column, NULLs ignored."""
    return rounded_mean(units(F.sum(column), 2, wide=True), F.count(column), 2, digits, wide=True)


def rounded_ratio(part: Column, whole: Column, digits: int, scale: int = 2) -> Column:
    """`part / whole` of two decimals with `scale` places, half up to `digits`; NULL when whole is 0."""
    return half_up(units(part, scale, wide=True), units(whole, scale, wide=True), digits)


def plain_ratio(part: Column, whole: Column, factor: float = 1.0) -> Column:
    """Unrounded double ratio; NULL when the whole is zero."""
    return F.try_divide(part.cast("double") * F.lit(float(factor)), whole.cast("double"))
