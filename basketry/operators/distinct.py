"""Exact distinct counts that merge: per group a set of numbers as bitmaps, so that any choice of groups is a union.

A set is kept as rows of (group, bucket, bits): a bucket stands for 32,768 neighbouring numbers. Sets combine on the map side and
are counted without reading the rows they came from. Ids that are no whole numbers are numbered densely first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.operators.ranking import running_totals


def dense_numbers(df: DataFrame, column: str, name: str = "number") -> DataFrame:
    """(column, number): the distinct values of a column that are not null, numbered from 1 in their order."""
    values = df.select(column).where(F.col(column).isNotNull()).distinct().withColumn("_one", F.lit(1).cast("bigint"))
    return running_totals(values, [F.col(column)], {name: "_one"}).drop("_one")


def distinct_sets(df: DataFrame, groups: Sequence[str], number: Column) -> DataFrame:
    """(groups, bucket, bits) of the whole numbers that each group holds; nulls are in no set."""
    keyed = df.select(*groups, number.cast("bigint").alias("_number")).where("_number IS NOT NULL")
    bucket = F.bitmap_bucket_number("_number").alias("bucket")
    return keyed.groupBy(*groups, bucket).agg(F.bitmap_construct_agg(F.bitmap_bit_position("_number")).alias("bits"))


def united(sets: DataFrame, groups: Sequence[str]) -> DataFrame:
    """The unions of sets that agree in the fewer `groups`."""
    return sets.groupBy(*groups, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def sizes(sets: DataFrame, groups: Sequence[str], name: str = "distinct") -> DataFrame:
    """How many different numbers the union of the sets of each of the `groups` holds; without groups, of all of them."""
    counted = united(sets, groups).select(*groups, F.bitmap_count("bits").alias("_n"))
    return counted.groupBy(*groups).agg(F.coalesce(F.sum("_n"), F.lit(0)).alias(name))


def repeated(df: DataFrame, column: str) -> DataFrame:
    """(column, copies) of whole numbers that occur more than once, nulls aside.

    Each range of 32,768 numbers is counted twice on the map side, by rows and by bits. Only rows of ranges where rows outnumber
    bits are grouped by number, so that on clean data one row per range and task is shuffled. Where numbers lie so far apart
    that the bits of all ranges would outweigh the rows (found when the plan runs), the rows are grouped as they are.
    """
    rows = df.select(column).where(F.col(column).isNotNull())
    width = F.max(column).cast("double") - F.min(column).cast("double")
    close = rows.agg((width / 32_768 * 4_096 <= F.count(F.lit(1)) * 16).alias("close")).scalar()
    close = F.coalesce(close, F.lit(False))
    bucket = F.bitmap_bucket_number(column).alias("_bucket")
    bits = F.bitmap_count(F.bitmap_construct_agg(F.bitmap_bit_position(column)))
    ranges = rows.where(close).groupBy(bucket).agg(F.count(F.lit(1)).alias("_rows"), bits.alias("_bits"))
    crowded = ranges.where("_rows > _bits").select("_bucket")
    again = rows.where(close).withColumn("_of", bucket).join(crowded, F.col("_of") == F.col("_bucket"), "left_semi").drop("_of")
    return again.unionByName(rows.where(~close)).groupBy(column).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")
