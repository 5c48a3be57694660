"""Time the headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS] and print one JSON line.

Every query is run to the end into a sink that keeps nothing; the figure is the median of three warm runs
(one for the model queries, whose fitted models are forgotten first). With --compare it prints a table of all
checked queries next to DuckDB instead.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from basketry.catalog.oracle import ORACLE
from basketry.catalog.queries import QUERIES, forget_models
from basketry.session import local_session

HEADLINE = (
    "category_revenue",
    "top_products",
    "dim_customers",
    "stg_order_items",
    "fct_events",
    "fct_orders",
    "mart_orders",
    "customer_metrics_left",
    "rfm_scored_ranged",
    "monthly_kpis",
    "overview_kpis",
    "spend_spread_by_segment",
    "ingest_profile",
    "dq_unique",
    "roc_curve",
    "forecast_report",
)
MODELS = ("churn_scores", "kmeans_segments")
TABLES = ("customer", "part", "orders", "lineitem", "events")


def run(spark, name: str, folder: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def warm_median(action) -> float:
    action()
    return round(statistics.median(action() for _ in range(3)), 3)


def compare(spark, folder: str, cpus: str) -> None:
    """Print every query that has checking SQL next to DuckDB on the same files."""
    import duckdb

    con = duckdb.connect(config={"threads": cpus})
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{folder}/{table}.parquet'")

    def check(sql: str) -> float:
        start = time.perf_counter()
        con.execute(sql).fetchall()
        return time.perf_counter() - start

    for name, sql in ORACLE.items():
        ours, theirs = warm_median(lambda: run(spark, name, folder)), warm_median(lambda: check(sql))
        print(f"| `{name}` | {ours:.2f} | {theirs:.2f} |", flush=True)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus)
    if "--compare" in sys.argv:
        return compare(spark, folder, cpus)
    seconds = {name: warm_median(lambda: run(spark, name, folder)) for name in HEADLINE}
    for name in MODELS:
        forget_models()
        seconds[name] = round(run(spark, name, folder), 3)
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": seconds, "sf": float(scale)}))
    spark.stop()


if __name__ == "__main__":
    main()
