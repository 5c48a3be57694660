from datetime import date
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketry.plans import churn, forecast, segments

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def scored(spark):
    rows = [(0, 0.1, 0), (0, 0.4, 0), (1, 0.35, 0), (1, 0.8, 1)]
    return spark.createDataFrame(rows, "churned int, churn_probability double, prediction int")


@pytest.mark.parametrize("method", ["window", "ranged"])
def test_auc_and_curve(scored, method):
    assert churn.roc_auc(scored, method=method).first()[0] == 0.75
    curve = [tuple(r) for r in churn.roc_curve(scored, method=method).collect()]
    assert curve == [(0.0, 0.0, None), (0.0, 0.5, 0.8), (0.5, 0.5, 0.4), (0.5, 1.0, 0.35), (1.0, 1.0, 0.1)]


def test_auc_counts_ties_half(spark):
    rows = [(0, 0.5), (1, 0.5), (1, 0.9), (0, 0.1)]
    frame = spark.createDataFrame(rows, "churned int, churn_probability double")
    assert churn.roc_auc(frame).first()[0] == 0.875


def test_classification_report(scored):
    found = {r["class"]: r for r in churn.classification_report(scored).collect()}
    assert found["Active"].precision == pytest.approx(2 / 3) and found["Active"].recall == 1.0
    assert (found["Churned"].precision, found["Churned"].recall) == (1.0, 0.5)
    assert found["accuracy"].f1 == 0.75 and found["macro avg"].support == 4
    assert found["weighted avg"].f1 == pytest.approx((0.8 * 2 + 2 / 3 * 2) / 4)


def test_report_without_a_predicted_class(spark):
    frame = spark.createDataFrame([(0, 0), (1, 0)], "churned int, prediction int")
    found = {r["class"]: r for r in churn.classification_report(frame).collect()}
    assert (found["Churned"].precision, found["Churned"].f1, found["Churned"].support) == (0.0, 0.0, 1)


@pytest.fixture(scope="module")
def shop(spark):
    from basketry.catalog.queries import Shop

    return Shop(spark, FOLDER)


def test_split_is_stratified_and_repeatable(shop):
    first = churn.stratified_split(shop.features)
    again = churn.stratified_split(shop.features.repartition(5), method="ranged")
    assert first.select("customer_id", "is_test").exceptAll(again.select("customer_id", "is_test")).isEmpty()
    for row in first.groupBy("churned").agg(F.count("*").alias("n"), F.count_if("is_test").alias("t")).collect():
        assert abs(row.t - row.n / 5) <= 0.5


def test_forest_scores_and_importance(shop):
    columns = ("frequency", "monetary")
    features = churn.churn_features(shop.metrics)
    model = churn.fit_forest(features, columns, trees=5, depth=3)
    found = churn.churn_scores(model, features, columns)
    assert found.count() == features.count()
    assert found.where("churn_probability < 0 OR churn_probability > 1").isEmpty()
    assert found.where("(churn_probability > 0.5) <> (prediction = 1)").where("churn_probability <> 0.5").isEmpty()
    ranked = [r.importance for r in churn.feature_importance(model, features, columns).collect()]
    assert sum(ranked) == pytest.approx(1.0) and ranked == sorted(ranked, reverse=True)


def test_standardised_columns_have_mean_0_and_population_deviation_1(shop):
    scaled = segments.standardise(segments.scored_customers(shop.metrics))
    for column in segments.COLUMNS:
        mean, deviation = scaled.agg(F.avg(f"z_{column}"), F.stddev_pop(f"z_{column}")).first()
        assert mean == pytest.approx(0, abs=1e-9) and deviation == pytest.approx(1)


def test_constant_column_stays_finite(spark):
    frame = spark.createDataFrame([(1, 2.0), (2, 2.0)], "customer_id int, x double")
    assert [r.z_x for r in segments.standardise(frame, ["x"]).collect()] == [0.0, 0.0]


def test_clusters(shop):
    customers = segments.scored_customers(shop.metrics)
    data = segments.vectors(customers).persist()
    best = segments.best_kmeans(data, [2, 3, 4], restarts=3)
    costs = [best[k].summary.trainingCost for k in (2, 3, 4)]
    assert costs == sorted(costs, reverse=True)
    assigned = segments.assign(best[4], data)
    profile = segments.cluster_profile(assigned).collect()
    assert sum(r.customers for r in profile) == customers.count()
    assert [r.label for r in profile] == list(segments.VALUE_LABELS)
    named = segments.label_clusters(assigned)
    means = {r.ml_segment: r.m for r in named.groupBy("ml_segment").agg(F.avg("monetary").alias("m")).collect()}
    assert sorted(means, key=means.get, reverse=True) == list(segments.SEGMENT_LABELS)


def _facts(spark, months):
    rows = [(f"o{m}", date(2023, m, 3), "completed", Decimal(total)) for m, total in months]
    return spark.createDataFrame(rows, "order_id string, order_date date, status string, order_total decimal(18,2)")


def test_series_does_not_count_missing_months(spark):
    series = forecast.monthly_series(_facts(spark, [(1, 10), (2, 20), (4, 40)])).orderBy("period").collect()
    assert [(r.period_idx, r.month_num) for r in series] == [(0, 1), (1, 2), (2, 4)]


def test_forecast_equals_least_squares(spark):
    months = [(m, 100 + 7 * m + (m * m) % 11) for m in range(1, 13)]
    series = forecast.monthly_series(_facts(spark, months)).persist()
    model = forecast.fit_trend(series)

    def design(indices, numbers):
        angle = 2 * np.pi * np.array(numbers) / 12
        return np.column_stack([np.ones(len(numbers)), indices, np.sin(angle), np.cos(angle)])

    x, y = design(range(12), range(1, 13)), np.array([t for _, t in months], float)
    weights, *_ = np.linalg.lstsq(x[:9], y[:9], rcond=None)
    errors = y[9:] - x[9:] @ weights
    metrics = forecast.forecast_metrics(forecast.fitted(model, series)).first()
    assert metrics.mae == pytest.approx(np.abs(errors).mean()) and metrics.rmse == pytest.approx((errors**2).mean() ** 0.5)
    ahead = forecast.forecast_next(model, series).collect()
    assert [r.period for r in ahead] == [date(2024, 1, 1), date(2024, 2, 1), date(2024, 3, 1)]
    assert [r.forecast for r in ahead] == pytest.approx(list(design([12, 13, 14], [1, 2, 3]) @ weights))
    report = forecast.forecast_report(model, series).first()
    assert report.month == "2024-01" and report.error_status == "Accurate"
    assert report.change_percent == pytest.approx((ahead[0].forecast / y[-1] - 1) * 100)
