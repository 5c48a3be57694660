"""Monthly revenue series, a linear trend with a yearly wave, and the next months."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketry.functions import rules
from basketry.functions.exact import plain_ratio

FEATURES = ("period_idx", "sin_month", "cos_month")


def _with_wave(df: DataFrame) -> DataFrame:
    month = F.month("period")
    sine, cosine = rules.month_wave(month)
    return df.withColumns({"month_num": month, "sin_month": sine, "cos_month": cosine})


def monthly_series(facts: DataFrame, status: str = "completed") -> DataFrame:
    """Revenue per month with its index and season. Months without orders are absent and not counted.

    The window holds one row per month.
    """
    sold = facts.where((F.col("status") == status) & F.col("order_date").isNotNull())
    months = sold.groupBy(F.trunc("order_date", "MM").alias("period")).agg(F.sum("order_total").alias("order_total"))
    indexed = months.withColumn("period_idx", F.row_number().over(Window.orderBy("period")) - 1)
    return _with_wave(indexed)


def split_last(series: DataFrame, holdout: int = 3) -> DataFrame:
    """Flag the last months as test rows."""
    latest = Window.orderBy(F.desc("period"))
    return series.withColumn("is_test", F.row_number().over(latest) <= holdout)


def _assemble(df: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(df)


def fit_trend(series: DataFrame, holdout: int = 3) -> LinearRegressionModel:
    """Least squares on all but the last months. Pass a materialised series: fitting reads it repeatedly."""
    train = _assemble(split_last(series, holdout).where("NOT is_test"))
    train = train.select("features", F.col("order_total").cast("double").alias("order_total"))
    return LinearRegression(labelCol="order_total", solver="normal", regParam=0.0).fit(train)


def predict(model: LinearRegressionModel, df: DataFrame) -> DataFrame:
    return model.transform(_assemble(df)).drop("features")


def fitted(model: LinearRegressionModel, series: DataFrame, holdout: int = 3) -> DataFrame:
    """Actual and predicted revenue per month, test months flagged."""
    return predict(model, split_last(series, holdout)).orderBy("period")


def forecast_metrics(fitted_series: DataFrame) -> DataFrame:
    """Mean absolute and root mean squared error over the test months."""
    error = F.col("order_total").cast("double") - F.col("prediction")
    tested = fitted_series.where("is_test")
    return tested.agg(F.avg(F.abs(error)).alias("mae"), F.sqrt(F.avg(error * error)).alias("rmse"))


def forecast_next(model: LinearRegressionModel, series: DataFrame, months: int = 3) -> DataFrame:
    """The months after the last one, with the change against its revenue. The model is not refitted."""
    last = series.agg(
        F.max("period").alias("_period"),
        F.max("period_idx").alias("_idx"),
        F.max_by("order_total", "period").alias("_total"),
    )
    ahead = last.select("*", F.explode(F.sequence(F.lit(1), F.lit(months))).alias("_step")).select(
        F.add_months("_period", F.col("_step")).alias("period"),
        (F.col("_idx") + F.col("_step")).alias("period_idx"),
        "_total",
    )
    forecast = predict(model, _with_wave(ahead)).withColumnRenamed("prediction", "forecast")
    change = plain_ratio(F.col("forecast"), F.col("_total")) - F.lit(1.0)
    return forecast.withColumn("change_percent", change * 100).drop("_total").orderBy("period")


def forecast_report(model: LinearRegressionModel, series: DataFrame, months: int = 3, holdout: int = 3) -> DataFrame:
    """Forecast per coming month with the model's error on the held-out months and its rating."""
    mae = forecast_metrics(fitted(model, series, holdout)).select("mae").scalar()
    ahead = forecast_next(model, series, months)
    rated = ahead.select(rules.period_label(F.col("period")).alias("month"), "forecast", "change_percent", mae.alias("mae"))
    return rated.withColumn("error_status", rules.error_status(F.col("mae"))).orderBy("month")
