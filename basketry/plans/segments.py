"""Customer clusters on recency, frequency and spend."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketry.functions import rules
from basketry.functions.exact import plain_ratio, rounded_mean, units
from basketry.operators.clustering import Blocks, best_runs, nearest_centre, silhouettes, step
from basketry.session import small_side

COLUMNS = ("recency_days", "frequency", "monetary")
VALUE_LABELS = ("High Value", "Mid Value", "Low Value", "Dormant")
SEGMENT_LABELS = ("Champions", "Loyal", "At Risk", "Dormant")


def scored_customers(metrics: DataFrame) -> DataFrame:
    return metrics.where("rfm_segment IS NOT NULL")


def standardise(df: DataFrame, columns: Sequence[str] = COLUMNS) -> DataFrame:
    """Add z_<column>: distance from the mean in population standard deviations (1 where all are equal)."""
    value = {c: F.col(c).cast("double") for c in columns}
    moments = df.agg(
        *(F.avg(v).alias(f"mean_{c}") for c, v in value.items()),
        *(F.stddev_pop(v).alias(f"sd_{c}") for c, v in value.items()),
    )
    stats = moments.select(F.struct(*moments.columns)).scalar()
    scaled = {
        f"z_{c}": (v - stats[f"mean_{c}"])
        / F.when(stats[f"sd_{c}"] == 0, F.lit(1.0)).otherwise(stats[f"sd_{c}"])
        for c, v in value.items()
    }
    return df.withColumns(scaled)


def vectors(df: DataFrame, columns: Sequence[str] = COLUMNS) -> DataFrame:
    """Customers with their standardised features as a vector, ready for clustering."""
    names = [f"z_{c}" for c in columns]
    assembled = VectorAssembler(inputCols=names, outputCol="features").transform(standardise(df, columns))
    return assembled.drop(*names)


def _fit(data: DataFrame, k: int, seed: int) -> KMeansModel:
    return KMeans(k=k, seed=seed, maxIter=300).fit(data)


def best_kmeans(
    data: DataFrame, ks: Iterable[int], restarts: int = 10, seed: int = 42, parallelism: int = 8
) -> dict[int, KMeansModel]:
    """For every k the model with the lowest cost over several seeds, fitted a few at a time."""
    tries = [(k, seed + i) for k in ks for i in range(restarts)]
    run = inheritable_thread_target(data.sparkSession)(lambda how: (how[0], _fit(data, *how)))
    with ThreadPool(min(parallelism, len(tries))) as pool:
        models = pool.map(run, tries)
    best: dict[int, KMeansModel] = {}
    for k, model in models:
        if k not in best or model.summary.trainingCost < best[k].summary.trainingCost:
            best[k] = model
    return best


def blocks(customers: DataFrame, columns: Sequence[str] = COLUMNS) -> Blocks:
    """Standardised customers packed for many clusterings at once; close it when done."""
    names = [f"z_{c}" for c in columns]
    return Blocks(standardise(customers, columns).select(*names), names)


def kmeans_sweep(points: Blocks, ks: Iterable[int] = range(2, 9), restarts: int = 10, seed: int = 42) -> DataFrame:
    """Cost and silhouette of the best of several runs per number of clusters; all runs share their scans.

    The silhouette uses squared Euclidean distances.
    """
    best = best_runs(points, list(ks), restarts, seed)
    rated = silhouettes(points, [run.centres for run in best.values()])
    rows = [(k, float(run.cost), value) for (k, run), value in zip(best.items(), rated, strict=True)]
    return points.scan.sparkSession.createDataFrame(rows, "k int, inertia double, silhouette_squared double").orderBy("k")


def nearest(customers: DataFrame, centres: Sequence[Sequence[float]], columns: Sequence[str] = COLUMNS) -> DataFrame:
    """Customers with the number of the nearest of the (standardised) centres and the squared distance to it."""
    scaled = standardise(customers, columns)
    number, squared = nearest_centre([F.col(f"z_{c}") for c in columns], centres)
    return scaled.withColumns({"cluster": number, "squared_distance": squared}).drop(*(f"z_{c}" for c in columns))


def lloyd_step(points: Blocks, centres: Sequence[Sequence[float]]) -> DataFrame:
    """Per cluster around `centres` that has points: how many, their squared distances, and the centre they move to."""
    found = step(points, [np.array(centres, dtype=float)])
    rows = [(c, many, float(cost), [float(x) for x in sums / many]) for (_, c), (many, cost, sums) in sorted(found.items())]
    return points.scan.sparkSession.createDataFrame(rows, "cluster int, customers long, cost double, centre array<double>")


def assign(model: KMeansModel, data: DataFrame) -> DataFrame:
    return model.transform(data).withColumnRenamed("prediction", "cluster").drop("features")


def _ranked(clusters: DataFrame, labels: Sequence[str]) -> DataFrame:
    """Label clusters by mean spend; the window holds one row per cluster."""
    by_spend = Window.orderBy(F.col("_mean").desc_nulls_last(), "cluster")
    return clusters.withColumn("label", rules.label_of(F.row_number().over(by_spend), labels, first=1)).drop("_mean")


def cluster_profile(df: DataFrame, labels: Sequence[str] = VALUE_LABELS) -> DataFrame:
    """Size and mean recency, frequency and spend per cluster, labelled from the highest spend down."""

    def mean(column: str, scale: int):
        total = units(F.sum(column), scale, wide=True)
        return rounded_mean(total, F.count(column), scale, 1, wide=True)

    clusters = df.groupBy("cluster").agg(
        F.count("customer_id").alias("customers"),
        mean("recency_days", 0).alias("avg_recency"),
        mean("frequency", 0).alias("avg_frequency"),
        mean("monetary", 2).alias("avg_spend"),
        plain_ratio(F.sum("monetary"), F.count("monetary")).alias("_mean"),
    )
    return _ranked(clusters, labels).orderBy(F.col("avg_spend").desc_nulls_last(), "cluster")


def label_clusters(df: DataFrame, labels: Sequence[str] = SEGMENT_LABELS, name: str = "ml_segment") -> DataFrame:
    """Give every customer the label of their cluster."""
    means = df.groupBy("cluster").agg(plain_ratio(F.sum("monetary"), F.count("monetary")).alias("_mean"))
    named = _ranked(means, labels).select(F.col("cluster").alias("_cluster"), F.col("label").alias(name))
    return df.join(small_side(named), F.col("cluster") == F.col("_cluster"), "left").drop("_cluster")
