from decimal import Decimal
from fractions import Fraction

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from basketry.functions import rules
from basketry.functions.exact import mean_money, plain_ratio, rounded_mean, rounded_ratio
from frames import day


def values(spark, rows, schema, column):
    return [r[0] for r in spark.createDataFrame(rows, schema).coalesce(1).select(column).collect()]


def test_price_tiers_are_half_open_and_unknown_price_is_top(spark):
    prices = [Decimal(p) for p in ("19.99", "20", "99.99", "100", "299.99", "300")] + [None]
    found = values(spark, [(p,) for p in prices], "p decimal(18,2)", rules.price_tier(F.col("p")))
    assert found == ["budget", "mid", "mid", "premium", "premium", "luxury", "luxury"]


def test_rfm_segment_bounds(spark):
    scores = [12, 10, 9, 7, 6, 5, 4, 3, None]
    found = values(spark, [(s,) for s in scores], "s int", rules.rfm_segment(F.col("s")))
    assert found == ["Champions"] * 2 + ["Loyal"] * 2 + ["At Risk"] * 2 + ["Lost"] * 2 + [None]


def test_risk_bins_are_right_closed_and_open_at_zero(spark):
    found = values(
        spark, [(p,) for p in (0.0, 0.3, 0.31, 0.6, 0.61, 1.0)], "p double", rules.churn_risk(F.col("p"))
    )
    assert found == [None, "Low", "Medium", "Medium", "High", "High"]


def test_churn_label_edge(spark):
    assert values(spark, [(179,), (180,)], "d int", rules.churned(F.col("d"))) == [0, 1]


def test_status_thresholds(spark):
    cancel = [(8.0,), (8.1,), (15.0,), (15.1,)]
    assert values(spark, cancel, "p double", rules.cancel_status(F.col("p"))) == ["Healthy", "Watch", "Watch", "High"]
    churn = [(0.3,), (0.31,), (0.5,), (0.51,)]
    assert values(spark, churn, "p double", rules.churn_status(F.col("p"))) == ["Low", "Moderate", "Moderate", "High"]
    error = [(9999.99,), (10000.0,), (25000.0,)]
    assert values(spark, error, "e double", rules.error_status(F.col("e"))) == ["Accurate", "Moderate", "Review model"]


def test_three_weekday_numberings(spark):
    sunday = spark.createDataFrame([(day("2024-01-07"),)], "d date")
    forms = (rules.dow_sunday1, rules.dow_sunday0, rules.dow_monday0)
    assert tuple(sunday.select(*(f(F.col("d")) for f in forms)).first()) == (1, 0, 6)


def test_names(spark):
    rows = [("Ann", "Lee"), (None, "Lee")]
    first, last = F.col("f"), F.col("l")
    assert values(spark, rows, "f string, l string", rules.full_name(first, last)) == ["Ann Lee", "Lee"]
    assert values(spark, rows, "f string, l string", rules.full_name_or_null(first, last)) == ["Ann Lee", None]


def test_margin(spark):
    rows = [(Decimal("0"), Decimal("4")), (Decimal("10"), Decimal("4")), (Decimal("3"), Decimal("4"))]
    found = values(spark, rows, "p decimal(18,2), c decimal(18,2)", rules.margin(F.col("p"), F.col("c")))
    assert found == [None, Decimal("0.6000"), Decimal("-0.3333")]


def test_net_price_rounds_the_exact_tie_up(spark):
    rows = [(Decimal("2.50"), Decimal("0.05"))]
    assert values(spark, rows, "u decimal(18,2), d decimal(18,2)", rules.net_price(F.col("u"), F.col("d"))) == [
        Decimal("2.38")
    ]


def test_line_total(spark):
    rows = [(3, Decimal("9.99"), Decimal("0.15"))]
    schema = "q int, u decimal(18,2), d decimal(18,2)"
    assert values(spark, rows, schema, rules.line_total(F.col("q"), F.col("u"), F.col("d"))) == [Decimal("25.47")]


def test_labels_and_display(spark):
    assert values(spark, [(0,), (6,), (7,)], "d int", rules.label_of(F.col("d"), rules.WEEKDAYS)) == ["Mon", "Sun", None]
    assert values(spark, [(1234.5,)], "x double", rules.display_money(F.col("x"))) == ["$1,234.50"]
    assert values(spark, [(0.1234,)], "x double", rules.display_percent(F.col("x"))) == ["12.3%"]
    assert values(spark, [(4.2,), (-4.2,)], "x double", rules.display_change(F.col("x"))) == ["+4.2%", "-4.2%"]


def half_up(value: Fraction, digits: int) -> Fraction:
    scaled = abs(value) * 10**digits
    whole = int(scaled + Fraction(1, 2))
    return (-whole if value < 0 else whole) * Fraction(1, 10**digits)


@settings(max_examples=12, deadline=None)
@given(st.lists(st.tuples(st.integers(-(10**9), 10**9), st.integers(1, 10**6)), min_size=20, max_size=40))
def test_means_and_ratios_round_half_up_exactly(spark, pairs):
    frame = spark.createDataFrame(pairs, "s bigint, n bigint").coalesce(1)
    s, n = F.col("s"), F.col("n")
    cases = {(2, 4): (False, 2, 4), (2, 1): (False, 2, 1), (12, 4): (True, 12, 4), (0, 1): (True, 0, 1)}
    for (scale, digits), (wide, *_ ) in cases.items():
        found = [r[0] for r in frame.select(rounded_mean(s, n, scale, digits, wide)).collect()]
        assert found == [float(half_up(Fraction(a, b * 10**scale), digits)) for a, b in pairs]
    money = frame.select((s.cast("decimal(18,2)") / 100).cast("decimal(18,2)").alias("p"), n.cast("decimal(18,2)").alias("w"))
    found = [r for r in money.select("p", "w", rounded_ratio(F.col("p"), F.col("w"), 4)).collect()]
    for part, whole, quotient in found:
        assert quotient == half_up(Fraction(part) / Fraction(whole), 4) * 10**4


def test_mean_money_and_empty_groups(spark):
    frame = spark.createDataFrame([(Decimal("0.01"),), (Decimal("0.02"),), (None,)], "m decimal(18,2)")
    assert frame.agg(mean_money("m")).first()[0] == 0.02
    assert frame.where("m IS NULL").agg(mean_money("m")).first()[0] is None
    assert frame.where("false").agg(plain_ratio(F.count("m"), F.count(F.lit(1)))).first()[0] is None


def test_month_wave(spark):
    sine, cosine = rules.month_wave(F.col("m"))
    row = spark.createDataFrame([(3,)], "m int").select(sine, cosine).first()
    assert row[0] == pytest.approx(1.0) and row[1] == pytest.approx(0.0, abs=1e-12)
