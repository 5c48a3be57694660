"""The daily job: ingest, gate, star schema, models with their data tests, statistics."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from basketry.functions import rules
from basketry.operators.quality import (
    DataQualityError,
    DataTest,
    Expectation,
    assert_quality,
    gate_report,
    run_data_tests,
)
from basketry.plans import facts, reports, rfm, staging
from basketry.session import tune
from basketry.sources.tables import read_raw, save_table, write_parquet


@dataclass(frozen=True)
class Model:
    name: str
    needs: tuple[str, ...]
    build: Callable[..., DataFrame]
    table: bool = False


# In build order: a model may need raw tables and earlier models.
MODELS = (
    Model("stg_customers", ("raw_customers",), staging.dim_customers),
    Model("stg_products", ("raw_products",), staging.dim_products),
    Model("stg_orders", ("raw_orders",), staging.stg_orders),
    Model("stg_order_items", ("raw_order_items",), staging.stg_order_items),
    Model(
        "mart_orders", ("stg_orders", "stg_customers", "stg_order_items", "stg_products"), facts.mart_orders, table=True
    ),
)

# The declared tests, with the allowed labels.
DATA_TESTS = (
    DataTest("stg_customers", "customer_id", "unique"),
    DataTest("stg_customers", "customer_id", "not_null"),
    DataTest("stg_customers", "email", "not_null"),
    DataTest("stg_customers", "segment", "accepted_values", ("VIP", "Regular", "At-Risk", "New")),
    DataTest("stg_orders", "order_id", "unique"),
    DataTest("stg_orders", "order_id", "not_null"),
    DataTest("stg_orders", "status", "accepted_values", ("completed", "pending", "cancelled", "refunded")),
    DataTest("stg_products", "product_id", "unique"),
    DataTest("stg_products", "product_id", "not_null"),
    DataTest("stg_order_items", "item_id", "unique"),
    DataTest("stg_order_items", "item_id", "not_null"),
)


def expectations(min_customers: int = 900) -> tuple[Expectation, ...]:
    return (
        Expectation("No null order IDs", "raw_orders", F.count_if(F.col("order_id").isNull()), "==", 0),
        Expectation("No negative revenue", "raw_orders", F.count_if(F.col("order_total") < 0), "==", 0),
        Expectation(
            "Customer count sanity", "raw_customers", F.count_distinct("customer_id"), ">=", min_customers
        ),
    )


def ingest(spark: SparkSession, folder: str, database: str = "default") -> dict[str, int]:
    """Replace the five raw tables from their CSV files; rows written per table."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    return {name: save_table(df, f"{database}.{name}") for name, df in read_raw(spark, folder).items()}


def raw_tables(spark: SparkSession, database: str = "default") -> dict[str, DataFrame]:
    names = ("raw_customers", "raw_products", "raw_orders", "raw_order_items", "raw_events")
    return {name: spark.table(f"{database}.{name}") for name in names}


def star_schema(raw: Mapping[str, DataFrame], unique_orders: bool = False, ranks: bool = True) -> dict[str, DataFrame]:
    """The five warehouse tables, as plans. Without `ranks` the customer metrics have no scores, and finding them starts no job."""
    customers = staging.dim_customers(raw["raw_customers"])
    products = staging.dim_products(raw["raw_products"])
    orders = staging.stg_orders(raw["raw_orders"], weekday=rules.dow_sunday1)
    base = rfm.rfm_base(raw["raw_orders"])
    scored = rfm.rfm_score(base) if ranks else base
    return {
        "dim_customers": customers,
        "dim_products": products,
        "fct_orders": facts.fct_orders(orders, raw["raw_order_items"], products, unique_orders=unique_orders),
        "fct_customer_metrics": rfm.customer_metrics(customers, scored),
        "fct_events": staging.fct_events(raw["raw_events"]),
    }


PARTITIONS = {"fct_orders": ("order_year", "order_month"), "fct_events": ("event_date",)}


def write_star_schema(tables: Mapping[str, DataFrame], folder: str) -> dict[str, int]:
    """Replace each table's Parquet directory; rows written per table."""
    return {name: write_parquet(df, f"{folder}/{name}", PARTITIONS.get(name, ())) for name, df in tables.items()}


def build_models(raw: Mapping[str, DataFrame], database: str | None = None) -> dict[str, DataFrame]:
    """Build the models in order: staging as temporary views, marts as tables (views without a database)."""
    known = dict(raw)
    for model in MODELS:
        df = model.build(*(known[n] for n in model.needs))
        if model.table and database is not None:
            save_table(df, f"{database}.{model.name}")
            df = df.sparkSession.table(f"{database}.{model.name}")
        else:
            df.createOrReplaceTempView(model.name)
        known[model.name] = df
    return {m.name: known[m.name] for m in MODELS}


@dataclass(frozen=True)
class Run:
    ingested: dict[str, int]
    written: dict[str, int]
    statistics: Row


def run_pipeline(
    spark: SparkSession, raw_folder: str, warehouse: str, database: str = "default", min_customers: int = 900
) -> Run:
    """Run every step; a failed gate or data test raises and stops the rest."""
    tune(spark)
    ingested = ingest(spark, raw_folder, database)
    raw = raw_tables(spark, database)
    assert_quality(gate_report(raw, expectations(min_customers)))
    unique_orders = facts.has_unique_orders(raw["raw_orders"])
    written = write_star_schema(star_schema(raw, unique_orders), warehouse)
    models = build_models(raw, database)
    failed = run_data_tests(models, DATA_TESTS).where("NOT passed").collect()  # at most one row per test
    if failed:
        lines = [f"{r.model}.{r.column_name} {r.test}: {r.failures} failures" for r in failed]
        raise DataQualityError("data tests failed:\n" + "\n".join(lines))
    return Run(ingested, written, reports.run_statistics(raw["raw_orders"]).first())
