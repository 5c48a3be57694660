"""Joins in which heavy keys, found by a sketch, are spread over several tasks, and stay so for what comes after.

A frequent-items sketch of one side's keys names those with more rows than a task should hold: a bounded list. Their rows get one
of several salts by their own hash, and the rows of the other side with such a key are copied once per salt; all other keys
are joined as ever. Adaptive execution splits a heavy key for a plain join only; here the rows leave the join dealt by key and
salt, so that a grouping by the key combines in each task before its shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TRACKED = 10_000  # items in the sketch: counts are off by a few ten-thousandths of the rows at most
HEAVIEST = 1_000  # keys that may be called heavy
MOST_SALTS = 1_000


def heavy_keys(df: DataFrame, key: str, tasks: int | None = None, times: float = 0.5) -> dict[object, int]:
    """Keys with more than `times` the rows of an even task, and among how many salts each is to be spread.

    One scan, combined on the map side. `tasks` is the number of shuffle partitions unless given; nulls are never heavy, as they
    join nothing.
    """
    tasks = tasks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    known = df.where(F.col(key).isNotNull())
    rows, top = known.agg(F.count(F.lit(1)), F.call_function("approx_top_k", F.col(key), F.lit(HEAVIEST), F.lit(TRACKED))).first()
    even = max(rows / tasks * times, 1.0)
    return {item["item"]: min(math.ceil(item["count"] / even), MOST_SALTS) for item in top or [] if item["count"] > even}


def _salts(key: str, heavy: Mapping[object, int]) -> Column:
    """How many salts a row's key has, 1 unless it is heavy."""
    by_number: dict[int, list] = {}
    for value, salts in heavy.items():
        by_number.setdefault(salts, []).append(value)
    chosen = F.lit(1)
    for salts, values in by_number.items():
        chosen = F.when(F.col(key).isin(values), salts).otherwise(chosen)
    return chosen


def spread_join(left: DataFrame, right: DataFrame, key: str, how: str = "inner", heavy: Mapping[object, int] | None = None) -> DataFrame:
    """`left` joined with `right` on `key` ('inner' or 'left'); the heavy keys are those of `left` unless given.

    Rows and columns are those of a plain join. Rows of `right` are copied by the number of salts of their key, so heavy keys of
    `left` should be light in `right`, as those of facts are in their dimensions. Without heavy keys it is the plain join.
    """
    if how not in ("inner", "left"):
        raise ValueError("how must be inner or left")
    heavy = heavy_keys(left, key) if heavy is None else heavy
    if not heavy:
        return left.join(right, key, how)
    # Equal rows spread too: the number that parts them has no meaning.
    own = F.pmod(F.xxhash64(F.monotonically_increasing_id()), _salts(key, heavy)).cast("int")
    salted = left.withColumn("_salt", own)
    copied = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), _salts(key, heavy) - 1)))
    return salted.join(copied, [key, "_salt"], how).drop("_salt")

