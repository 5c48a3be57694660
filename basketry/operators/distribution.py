"""Frequencies, histograms and value lists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.functions.exact import plain_ratio


def value_counts(df: DataFrame, column: str, count: str = "rows", label: str | None = None) -> DataFrame:
    """Rows per non-NULL value and their share, most frequent first."""
    label = label or column
    counts = (
        df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias(label)).agg(F.count(F.lit(1)).alias(count))
    )
    total = counts.agg(F.sum(count)).scalar()
    shares = counts.withColumn("share", plain_ratio(F.col(count), total))
    return shares.orderBy(F.desc(count), label)


def distinct_sorted(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).where(F.col(column).isNotNull()).distinct().orderBy(column)


def histogram(df: DataFrame, column: str, bins: int = 40, count: str = "rows") -> DataFrame:
    """Equal-width bins between minimum and maximum, the last one closed; empty bins are kept."""
    values = df.select(F.col(column).cast("double").alias("_v")).where("_v IS NOT NULL")
    bounds = values.agg(F.min("_v").alias("a"), F.max("_v").alias("b")).select(
        F.when(F.col("a") == F.col("b"), F.struct((F.col("a") - 0.5).alias("a"), (F.col("b") + 0.5).alias("b")))
        .otherwise(F.struct("a", "b"))
        .alias("bounds")
    )
    bounds = bounds.scalar()
    low, high = bounds["a"], bounds["b"]
    place = F.floor(F.lit(float(bins)) * (F.col("_v") - low) / (high - low)).cast("int") + 1
    counts = values.groupBy(F.least(place, F.lit(bins)).alias("_bin")).agg(F.count(F.lit(1)).alias("_n"))
    width = (high - low) / F.lit(float(bins))
    every = df.sparkSession.range(1, bins + 1, numPartitions=1).select(F.col("id").cast("int").alias("bin"))
    return (
        every.join(counts, F.col("bin") == F.col("_bin"), "left")
        .select(
            "bin",
            (low + width * (F.col("bin") - 1)).alias("low"),
            (low + width * F.col("bin")).alias("high"),
            F.coalesce(F.col("_n"), F.lit(0).cast("bigint")).alias(count),
        )
        .orderBy("bin")
    )
