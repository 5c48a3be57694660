"""One query per operator over the sample tables, whole and unfiltered."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.functions import rules
from basketry.operators import quality
from basketry.operators.clustering import best_runs
from basketry.operators.dedup import any_per_key
from basketry.operators.skew import spread_join
from basketry.plans import churn, facts, forecast, maintenance, reports, rfm, segments, staging, warehouse
from basketry.session import materialise, shared_folder, tune
from basketry.sources.ranged import RangedTable
from basketry.sources.sample_tables import raw_table
from basketry.sources.versioned import VersionedTable
from basketry.store import Memo

YEARS = (1996, 1998)
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


class Shop:
    """The raw and staged tables of one folder, built when first used."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = tune(spark), folder
        self._raw: dict[str, DataFrame] = {}

    def raw(self, name: str) -> DataFrame:
        if name not in self._raw:
            self._raw[name] = raw_table(self.spark, self.folder, f"raw_{name}")
        return self._raw[name]

    @cached_property
    def customers(self) -> DataFrame:
        return staging.dim_customers(self.raw("customers"))

    @cached_property
    def products(self) -> DataFrame:
        return staging.dim_products(self.raw("products"))

    @cached_property
    def orders(self) -> DataFrame:
        return staging.stg_orders(self.raw("orders"))

    @cached_property
    def items(self) -> DataFrame:
        return staging.stg_order_items(self.raw("order_items"))

    @cached_property
    def facts(self) -> DataFrame:
        return self.order_facts()

    @cached_property
    def unique_orders(self) -> bool:
        return facts.has_unique_orders(self.raw("orders"))

    def order_facts(self, raw_margin: bool = False) -> DataFrame:
        orders = staging.stg_orders(self.raw("orders"), weekday=rules.dow_sunday1)
        products = self.products if not raw_margin else self.raw("products")
        return facts.fct_orders(orders, self.raw("order_items"), products, raw_margin, self.unique_orders)

    @cached_property
    def base(self) -> DataFrame:
        return rfm.rfm_base(self.raw("orders"))

    @cached_property
    def scored(self) -> DataFrame:
        return rfm.rfm_score(self.base)

    @cached_property
    def metrics(self) -> DataFrame:
        return rfm.customer_metrics(self.customers, self.scored)

    @cached_property
    def features(self) -> DataFrame:
        return churn.churn_features(self.metrics)

    @cached_property
    def stand_in(self) -> DataFrame:
        """A fixed score and cluster per customer, so that the measures on them can be checked in SQL."""
        scored = self.features.withColumns(
            {
                "churn_probability": (F.col("customer_id") * 37 % 101) / F.lit(100.0),
                "cluster": (F.col("customer_id") % 4).cast("int"),
            }
        )
        return scored.withColumn("prediction", (F.col("churn_probability") > 0.5).cast("int"))

    @cached_property
    def judged(self) -> DataFrame:
        """The stand-in with risk bands and named clusters, as the customer insights have them."""
        risk = rules.churn_risk(F.col("churn_probability"))
        return segments.label_clusters(self.stand_in.withColumn("churn_risk", risk))

    @cached_property
    def series(self) -> DataFrame:
        return materialise(forecast.monthly_series(self.facts))[0]

    @cached_property
    def trend(self):
        return forecast.fit_trend(self.series)


def plain(df: DataFrame) -> DataFrame:
    """Money as double and sets as text, for comparison with other engines."""
    out = []
    for field in df.schema.fields:
        column = F.col(field.name)
        if isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, T.ArrayType):
            column = F.array_join(column, ",")
        out.append(column.alias(field.name))
    return df.select(*out)


def query(build: Callable[[Shop], DataFrame]) -> Callable[[Shop], DataFrame]:
    QUERIES[build.__name__] = lambda spark, folder: plain(build(Shop(spark, folder)))
    return build


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    """Round doubles whose last bits depend on summation order; adding 0 turns -0.0 into 0.0."""
    return df.withColumns({c: F.round(c, digits) + F.lit(0.0) for c in columns})


# --- raw and staged tables -----------------------------------------------------------------------------


@query
def raw_customers(shop: Shop) -> DataFrame:
    return shop.raw("customers")


@query
def dim_customers(shop: Shop) -> DataFrame:
    return shop.customers


@query
def dim_customers_strict_name(shop: Shop) -> DataFrame:
    named = staging.dim_customers(shop.raw("customers"), name=rules.full_name_or_null)
    return named.select("customer_id", "full_name")


@query
def dedup_counts(shop: Shop) -> DataFrame:
    raw = shop.raw("customers")
    return reports.dedup_counts(raw, shop.customers, any_per_key(raw, ["customer_id"]))


@query
def dim_products(shop: Shop) -> DataFrame:
    return shop.products


@query
def stg_orders(shop: Shop) -> DataFrame:
    return shop.orders


@query
def stg_order_items(shop: Shop) -> DataFrame:
    return shop.items


@query
def line_total_check(shop: Shop) -> DataFrame:
    """Lines whose total is not quantity 1 x price x (1 - discount): the sample price is per line."""
    expected = rules.line_total(F.lit(1), F.col("unit_price"), F.col("discount"))
    differs = F.count_if(~F.col("line_total").eqNullSafe(expected))
    return shop.raw("order_items").agg(F.count(F.lit(1)).alias("lines"), differs.alias("differing"))


@query
def fct_events(shop: Shop) -> DataFrame:
    return staging.fct_events(shop.raw("events"))


@query
def weekday_forms(shop: Shop) -> DataFrame:
    return facts.weekday_forms(shop.orders)


# --- facts ---------------------------------------------------------------------------------------------


@query
def fct_orders(shop: Shop) -> DataFrame:
    return shop.facts


@query
def fct_orders_raw_margin(shop: Shop) -> DataFrame:
    return shop.order_facts(raw_margin=True).select("order_id", "avg_margin")


@query
def mart_orders(shop: Shop) -> DataFrame:
    return facts.mart_orders(shop.orders, shop.customers, shop.items, shop.products, shop.unique_orders)


@query
def mart_orders_any_copies(shop: Shop) -> DataFrame:
    """The same without relying on unique order ids."""
    return facts.mart_orders(shop.orders, shop.customers, shop.items, shop.products)


def _at(shop: Shop) -> str:
    """A new path in the shared folder."""
    return f"{shared_folder(shop.spark)}/{shop.spark.sparkContext.applicationId}/kept-{uuid.uuid4().hex}"


@query
def fct_orders_maintained(shop: Shop) -> DataFrame:
    """Order facts from totals that started from other lines and were changed twice: a third of the lines came later, another third
    had other prices, and some lines went."""
    items, third = shop.raw("order_items"), F.pmod(F.xxhash64("order_id", "product_id", "item_id"), F.lit(3))
    nothing = items.limit(0)
    wrong = items.where(third == 1).withColumn("line_total", (F.col("line_total") + 1).cast("decimal(18,2)"))
    extra = items.where(third == 2).withColumn("order_id", F.col("order_id") + 1)
    totals = maintenance.LineTotals(shop.spark, _at(shop), buckets=8)
    totals.rebuild(items.where(third == 2).unionByName(wrong).unionByName(extra), shop.products)
    totals.apply(items.where(third == 0), extra, shop.products)
    totals.apply(items.where(third == 1), wrong, shop.products)
    totals.apply(nothing, nothing, shop.products)
    orders = staging.stg_orders(shop.raw("orders"), weekday=rules.dow_sunday1)
    return maintenance.order_facts(orders, totals.state())


@query
def fct_orders_versions(shop: Shop) -> DataFrame:
    """Order facts read from a versioned table of which some months were replaced after a first, wrong version."""
    table, by = VersionedTable(shop.spark, _at(shop)), ["order_year", "order_month"]
    late = F.col("order_year") >= YEARS[0]
    table.write(shop.facts.withColumn("num_items", F.when(late, F.lit(-1).cast("bigint")).otherwise(F.col("num_items"))), by)
    table.write(shop.facts.where(late), by, only_touched=True)
    return table.read().select(*shop.facts.columns)


@query
def overview_kpis_pruned(shop: Shop) -> DataFrame:
    """The figures of some years from facts laid out by year and customer, of which only the files of those years are read."""
    table, columns = RangedTable(shop.spark, _at(shop)), ["order_year", "customer_id"]
    table.write(shop.facts, columns, files=32)
    return reports.overview_kpis(table.read(shop.facts.schema, {"order_year": list(YEARS)}))


@query
def product_revenue_spread(shop: Shop) -> DataFrame:
    """Lines and revenue per product, joined with heavy products spread and orders' customers spread."""
    lines = spread_join(shop.raw("order_items").select("order_id", "product_id", "line_total"), shop.raw("products").select("product_id", "category"), "product_id", "left")
    return lines.groupBy("product_id", "category").agg(F.count(F.lit(1)).alias("lines"), F.sum("line_total").alias("revenue"))


@query
def customer_orders_spread(shop: Shop) -> DataFrame:
    """Orders with their customer's segment, heavy customers spread."""
    orders = shop.orders.select("order_id", "customer_id", "status")
    return spread_join(orders, shop.customers.select("customer_id", "full_name", "segment"), "customer_id", "left")


@query
def customers_by_month(shop: Shop) -> DataFrame:
    """Different customers per month, from sets kept per month."""
    return maintenance.customers_in(maintenance.monthly_customers(shop.facts), groups=["order_year", "order_month"])


@query
def customers_by_year(shop: Shop) -> DataFrame:
    """Different customers per year, as unions of the months' sets."""
    return maintenance.customers_in(maintenance.monthly_customers(shop.facts), groups=["order_year"])


@query
def customers_in_years(shop: Shop) -> DataFrame:
    """Different customers in a choice of years, as a union of months."""
    return maintenance.customers_in(maintenance.monthly_customers(shop.facts), YEARS)


@query
def revenue_reconciliation(shop: Shop) -> DataFrame:
    return facts.revenue_reconciliation(shop.raw("orders"), shop.raw("order_items"))


@query
def rfm_base(shop: Shop) -> DataFrame:
    return shop.base


@query
def rfm_scored(shop: Shop) -> DataFrame:
    return shop.scored


@query
def rfm_scored_asc(shop: Shop) -> DataFrame:
    return rfm.rfm_score(shop.base, recency_ascending=True)


@query
def rfm_scored_ranged(shop: Shop) -> DataFrame:
    return rfm.rfm_score(shop.base, method="ranged")


@query
def customer_metrics_left(shop: Shop) -> DataFrame:
    return shop.metrics


@query
def customer_metrics_inner(shop: Shop) -> DataFrame:
    kept = ["customer_id", "full_name", "segment", *rfm.MEASURES, *rfm.SCORES, "rfm_score", "rfm_segment"]
    return rfm.customer_metrics(shop.customers, shop.scored, "inner").select(*kept)


# --- reports -------------------------------------------------------------------------------------------


@query
def rfm_segment_breakdown(shop: Shop) -> DataFrame:
    return reports.segment_breakdown(shop.metrics)


@query
def top_revenue_months(shop: Shop) -> DataFrame:
    return reports.top_revenue_months(shop.facts)


@query
def category_revenue(shop: Shop) -> DataFrame:
    return reports.category_revenue(shop.raw("order_items"), shop.raw("products"), shop.raw("orders"))


@query
def top_products(shop: Shop) -> DataFrame:
    return reports.top_products(shop.raw("order_items"), shop.raw("products"), shop.raw("orders"))


@query
def monthly_kpis(shop: Shop) -> DataFrame:
    return reports.monthly_kpis(shop.facts)


@query
def monthly_revenue(shop: Shop) -> DataFrame:
    return reports.monthly_revenue(shop.facts)


@query
def overview_kpis(shop: Shop) -> DataFrame:
    return reports.overview_kpis(shop.facts)


@query
def overview_kpis_by_years(shop: Shop) -> DataFrame:
    return reports.overview_kpis(shop.facts, YEARS)


@query
def year_choices(shop: Shop) -> DataFrame:
    return reports.year_choices(shop.orders)


@query
def category_choices(shop: Shop) -> DataFrame:
    return reports.category_choices(shop.products)


@query
def status_breakdown(shop: Shop) -> DataFrame:
    return reports.status_breakdown(shop.facts)


@query
def weekday_revenue(shop: Shop) -> DataFrame:
    return reports.weekday_revenue(shop.facts)


@query
def product_kpis(shop: Shop) -> DataFrame:
    return reports.product_kpis(shop.products)


@query
def price_tier_distribution(shop: Shop) -> DataFrame:
    return reports.price_tier_distribution(shop.products)


@query
def customer_kpis(shop: Shop) -> DataFrame:
    return reports.customer_kpis(shop.customers)


@query
def customer_segment_distribution(shop: Shop) -> DataFrame:
    return reports.customer_segment_distribution(shop.customers)


@query
def rfm_distribution(shop: Shop) -> DataFrame:
    return reports.rfm_distribution(shop.metrics)


@query
def recency_monetary_points(shop: Shop) -> DataFrame:
    return reports.recency_monetary_points(shop.metrics)


@query
def spend_histogram(shop: Shop) -> DataFrame:
    return rounded(reports.spend_histogram(shop.metrics), 2, "low", "high")


@query
def spend_spread_by_segment(shop: Shop) -> DataFrame:
    return rounded(reports.spread_by_segment(shop.metrics, "monetary"), 4, *reports.FIVE_NUMBERS)


@query
def spend_spread_ranged(shop: Shop) -> DataFrame:
    spread = reports.spread_by_segment(shop.metrics, "monetary", method="ranged")
    return rounded(spread, 4, *reports.FIVE_NUMBERS)


@query
def run_statistics(shop: Shop) -> DataFrame:
    return reports.run_statistics(shop.raw("orders"))


@query
def warehouse_counts(shop: Shop) -> DataFrame:
    names = ("customers", "products", "orders", "order_items", "events")
    raw = {f"raw_{n}": shop.raw(n) for n in names}
    return reports.warehouse_counts(warehouse.star_schema(raw, ranks=False))


@query
def ingest_profile(shop: Shop) -> DataFrame:
    names = ("customers", "orders", "order_items", "events")
    return reports.ingest_profile({f"raw_{n}": shop.raw(n) for n in names})


# --- data quality --------------------------------------------------------------------------------------


def _data_tests(shop: Shop, kind: str) -> DataFrame:
    models = {
        "stg_customers": shop.customers,
        "stg_products": shop.products,
        "stg_orders": shop.orders,
        "stg_order_items": shop.items,
    }
    return quality.run_data_tests(models, [t for t in warehouse.DATA_TESTS if t.kind == kind])


@query
def dq_unique(shop: Shop) -> DataFrame:
    return _data_tests(shop, "unique")


@query
def dq_not_null(shop: Shop) -> DataFrame:
    return _data_tests(shop, "not_null")


@query
def dq_accepted_values(shop: Shop) -> DataFrame:
    return _data_tests(shop, "accepted_values")


@query
def dq_gate_report(shop: Shop) -> DataFrame:
    tables = {"raw_orders": shop.raw("orders"), "raw_customers": shop.raw("customers")}
    return quality.gate_report(tables, warehouse.expectations())


# --- churn ---------------------------------------------------------------------------------------------


@query
def churn_features(shop: Shop) -> DataFrame:
    return shop.features


@query
def stratified_split(shop: Shop) -> DataFrame:
    return churn.stratified_split(shop.features).select("customer_id", "churned", "is_test")


@query
def stratified_split_ranged(shop: Shop) -> DataFrame:
    return churn.stratified_split(shop.features, method="ranged").select("customer_id", "churned", "is_test")


@query
def churn_risk_bins(shop: Shop) -> DataFrame:
    risk = rules.churn_risk(F.col("churn_probability")).alias("churn_risk")
    return shop.stand_in.select("customer_id", "churn_probability", risk)


@query
def confusion_matrix(shop: Shop) -> DataFrame:
    return churn.confusion_matrix(shop.stand_in)


@query
def classification_report(shop: Shop) -> DataFrame:
    return rounded(churn.classification_report(shop.stand_in), 9, "precision", "recall", "f1")


@query
def roc_auc(shop: Shop) -> DataFrame:
    return churn.roc_auc(shop.stand_in)


@query
def roc_curve(shop: Shop) -> DataFrame:
    return churn.roc_curve(shop.stand_in)


@query
def roc_curve_ranged(shop: Shop) -> DataFrame:
    return churn.roc_curve(shop.stand_in, method="ranged")


@query
def cluster_profile(shop: Shop) -> DataFrame:
    return segments.cluster_profile(shop.stand_in)


# Standardised centres, near which no customer is equally far from two.
CENTRES = ((-0.71, 0.83, 0.91), (0.13, 0.07, -0.11), (1.53, -1.09, -0.97), (-0.59, -0.67, -0.53))


@query
def kmeans_nearest(shop: Shop) -> DataFrame:
    """Nearest of fixed centres."""
    found = segments.nearest(segments.scored_customers(shop.metrics), CENTRES)
    return rounded(found.select("customer_id", "cluster", "squared_distance"), 6, "squared_distance")


@query
def kmeans_step(shop: Shop) -> DataFrame:
    """One step from fixed centres: where they move to."""
    points = segments.blocks(segments.scored_customers(shop.metrics))
    moved = segments.lloyd_step(points, CENTRES)
    points.close()
    spread = moved.select("cluster", "customers", "cost", *(F.col("centre")[i].alias(f"z_{c}") for i, c in enumerate(segments.COLUMNS)))
    return rounded(spread, 6, "cost", *(f"z_{c}" for c in segments.COLUMNS))


@query
def churn_kpis_fixed(shop: Shop) -> DataFrame:
    return rounded(churn.churn_kpis(shop.judged), 9, "avg_churn_probability")


@query
def churn_risk_distribution_fixed(shop: Shop) -> DataFrame:
    return churn.risk_distribution(shop.judged)


@query
def ml_segment_distribution_fixed(shop: Shop) -> DataFrame:
    return churn.ml_segment_distribution(shop.judged)


@query
def churn_spread_by_segment_fixed(shop: Shop) -> DataFrame:
    return rounded(reports.spread_by_segment(shop.judged, "churn_probability"), 9, *reports.FIVE_NUMBERS)


@query
def top_churn_fixed(shop: Shop) -> DataFrame:
    return churn.top_churn(shop.judged)


@query
def customer_insights_fixed(shop: Shop) -> DataFrame:
    columns = ["customer_id", "churn_probability", "prediction", "churn_risk", "cluster", "ml_segment"]
    return shop.judged.select(*columns)


@query
def scaled_features(shop: Shop) -> DataFrame:
    names = [f"z_{c}" for c in segments.COLUMNS]
    scaled = segments.standardise(segments.scored_customers(shop.metrics))
    return rounded(scaled.select("customer_id", *names), 6, *names)


# Fitted models and their tables are kept by the content they were fitted to, as the reports on them share one training.
_MEMOS: dict[str, Memo] = {}


def forget_models() -> None:
    for memo in _MEMOS.values():
        memo.close()
    _MEMOS.clear()


def _kept(shop: Shop, name: str, build: Callable[[], object]):
    application = shop.spark.sparkContext.applicationId
    if application not in _MEMOS:
        _MEMOS[application] = Memo(shop.spark)
    return _MEMOS[application].get(name, (shop.raw("customers"), shop.raw("orders")), build)


def _features(shop: Shop) -> DataFrame:
    return _kept(shop, "features", lambda: shop.features)


def _split(shop: Shop) -> DataFrame:
    return _kept(shop, "split", lambda: churn.stratified_split(_features(shop)))


def _forest(shop: Shop):
    """Trained on four fifths of the customers."""
    return _kept(shop, "forest", lambda: churn.fit_forest(_split(shop).where("NOT is_test")))


def _judged(shop: Shop) -> DataFrame:
    """Everyone's scores by that forest, once, and who was held out."""
    return _kept(shop, "judged", lambda: churn.churn_scores(_forest(shop), _split(shop)))


def _tested(shop: Shop) -> DataFrame:
    return _judged(shop).where("is_test")


def _blocks(shop: Shop):
    return _kept(shop, "blocks", lambda: segments.blocks(_features(shop)))


def _clustered(shop: Shop) -> DataFrame:
    def build() -> DataFrame:
        run = best_runs(_blocks(shop), [4])[4]
        assigned = segments.label_clusters(segments.nearest(_features(shop), run.centres))
        return assigned.select("customer_id", *segments.COLUMNS, "cluster", "ml_segment")

    return _kept(shop, "clustered", build)


def _customer_insights(shop: Shop) -> DataFrame:
    """Everyone scored by a forest trained on everyone, with cluster segments."""

    def build() -> DataFrame:
        forest = churn.fit_forest(_features(shop), min_leaf=1)
        named = _clustered(shop).select("customer_id", "cluster", "ml_segment")
        return churn.churn_scores(forest, _features(shop)).join(named, "customer_id")

    return _kept(shop, "insights", build)


@query
def churn_scores(shop: Shop) -> DataFrame:
    return _judged(shop).drop("is_test")


@query
def churn_holdout_confusion(shop: Shop) -> DataFrame:
    return churn.confusion_matrix(_tested(shop))


@query
def churn_holdout_report(shop: Shop) -> DataFrame:
    return churn.classification_report(_tested(shop))


@query
def churn_holdout_auc(shop: Shop) -> DataFrame:
    return churn.roc_auc(_tested(shop))


@query
def churn_holdout_roc(shop: Shop) -> DataFrame:
    return churn.roc_curve(_tested(shop))


@query
def feature_importance(shop: Shop) -> DataFrame:
    return churn.feature_importance(_forest(shop), _features(shop))


@query
def top_churn_holdout(shop: Shop) -> DataFrame:
    return churn.top_churn(_judged(shop), 10)


@query
def customer_insights(shop: Shop) -> DataFrame:
    return _customer_insights(shop)


@query
def churn_kpis(shop: Shop) -> DataFrame:
    return churn.churn_kpis(_customer_insights(shop))


@query
def churn_risk_distribution(shop: Shop) -> DataFrame:
    return churn.risk_distribution(_customer_insights(shop))


@query
def ml_segment_distribution(shop: Shop) -> DataFrame:
    return churn.ml_segment_distribution(_customer_insights(shop))


@query
def churn_spread_by_segment(shop: Shop) -> DataFrame:
    return reports.spread_by_segment(_customer_insights(shop), "churn_probability")


@query
def top_churn(shop: Shop) -> DataFrame:
    return churn.top_churn(_customer_insights(shop))


# --- clusters ------------------------------------------------------------------------------------------


@query
def kmeans_sweep(shop: Shop) -> DataFrame:
    return segments.kmeans_sweep(_blocks(shop))


@query
def kmeans_segments(shop: Shop) -> DataFrame:
    return _clustered(shop)


@query
def kmeans_profile(shop: Shop) -> DataFrame:
    return segments.cluster_profile(_clustered(shop))


# --- forecast ------------------------------------------------------------------------------------------


@query
def series_features(shop: Shop) -> DataFrame:
    return rounded(forecast.monthly_series(shop.facts), 9, "sin_month", "cos_month")


@query
def forecast_fit(shop: Shop) -> DataFrame:
    both = forecast.fitted(shop.trend, shop.series)
    return rounded(both.select("period", "order_total", "is_test", "prediction"), 2, "prediction")


@query
def forecast_metrics(shop: Shop) -> DataFrame:
    return rounded(forecast.forecast_metrics(forecast.fitted(shop.trend, shop.series)), 2, "mae", "rmse")


@query
def forecast_next(shop: Shop) -> DataFrame:
    ahead = forecast.forecast_next(shop.trend, shop.series).select("period", "period_idx", "forecast", "change_percent")
    return rounded(rounded(ahead, 2, "forecast"), 6, "change_percent")


@query
def forecast_report(shop: Shop) -> DataFrame:
    report = forecast.forecast_report(shop.trend, shop.series)
    return rounded(rounded(report, 2, "forecast", "mae"), 6, "change_percent")
