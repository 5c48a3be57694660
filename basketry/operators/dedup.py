"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str], latest: str) -> DataFrame:
    """The row with the greatest `latest` per key, NULL last; the other columns break ties.

    Spark keeps at most one row per key and map task before the shuffle (WindowGroupLimit), so a key with
    very many copies does not travel whole.
    """
    rest = sorted(c for c in df.columns if c not in (*keys, latest))
    order = [F.col(latest).desc_nulls_last(), *(F.col(c).asc_nulls_last() for c in rest)]
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(window)).where("_rn = 1").drop("_rn")


def any_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Some row per key: enough when the copies are identical."""
    return df.dropDuplicates(list(keys))
