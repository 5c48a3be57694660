"""Heavy keys spread over tasks, and files left out by their bounds."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketry.operators import skew
from basketry.sources.ranged import RangedTable, curve

OFF = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "20"}


@pytest.fixture
def plain_tasks(spark):
    before = {name: spark.conf.get(name) for name in OFF}
    for name, value in OFF.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def lines(spark, rows=60_000):
    n = F.col("id")
    key = F.when(n % 3 == 0, "hot").when(n % 10 == 1, "warm").when(n % 1000 == 4, None).otherwise(F.concat(F.lit("k"), (n % 5000).cast("string")))
    return spark.range(rows).select(key.alias("k"), (n % 100).alias("v")).repartition(7)


def test_heavy_keys_are_found_and_counted(spark):
    heavy = skew.heavy_keys(lines(spark), "k", tasks=20)
    assert set(heavy) == {"hot", "warm"} and heavy["hot"] >= 13 and 3 <= heavy["warm"] < heavy["hot"]
    assert skew.heavy_keys(spark.range(1000).selectExpr("id as k"), "k", tasks=10) == {}
    assert skew.heavy_keys(spark.range(0).selectExpr("id as k"), "k") == {}


@pytest.mark.parametrize("how", ["inner", "left"])
def test_spread_join_equals_the_plain_one_and_is_even(spark, plain_tasks, how):
    left = lines(spark)
    right = spark.range(5000).selectExpr("concat('k', id) as k", "id as w").unionByName(
        spark.createDataFrame([("hot", 1), ("hot", 2), ("warm", 3), (None, 4)], "k string, w long")
    )
    plain, spread = left.join(right, "k", how), skew.spread_join(left, right, "k", how)
    assert plain.columns == spread.columns and plain.exceptAll(spread).isEmpty() and spread.exceptAll(plain).isEmpty()

    def tasks(df):
        return [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]

    assert max(tasks(plain)) > 6 * np.median(tasks(plain)) and max(tasks(spread)) < 3 * np.median(tasks(spread))
    sums = lambda df: df.groupBy("k").agg(F.count(F.lit(1)), F.sum("v"), F.sum("w"))
    assert sums(plain).exceptAll(sums(spread)).isEmpty() and sums(spread).exceptAll(sums(plain)).isEmpty()
    with pytest.raises(ValueError):
        skew.spread_join(left, right, "k", "full")


def test_files_outside_of_the_bounds_are_not_read(spark, tmp_path):
    n = F.col("id")
    frame = spark.range(40_000).select((1990 + n % 10).cast("int").alias("year"), F.xxhash64(n).alias("customer"), F.when(n % 50 > 0, n % 77).alias("x"))
    table = RangedTable(spark, str(tmp_path / "t"))
    table.write(frame, ["year", "customer"], files=40)
    everything = table.files()
    assert 35 <= len(everything) <= 45 and table.read(frame.schema).exceptAll(frame).isEmpty() and table.read(frame.schema).count() == 40_000
    # 40 files are some six steps a column: a value is in about a quarter of them, two values apart in half.
    for wanted, condition, share in (
        ({"year": [1993]}, "year = 1993", 0.4),
        ({"year": [1993, 1997]}, "year in (1993, 1997)", 0.65),
        ({"customer": (-(2**61), 0)}, f"customer between {-(2**61)} and 0", 0.55),
        ({"year": [1995], "customer": (0, 2**60)}, f"year = 1995 and customer between 0 and {2**60}", 0.2),
        ({"year": [1800]}, "false", 0.01),
    ):
        found, expected = table.read(frame.schema, wanted), frame.where(condition)
        assert found.exceptAll(expected).isEmpty() and expected.exceptAll(found).isEmpty()
        assert len(table.files(wanted)) < share * len(everything)
        assert set(found.inputFiles()) <= set(table.files(wanted))


def test_curve_has_even_bins_and_takes_texts_days_and_nulls(spark, tmp_path):
    n = F.col("id")
    frame = spark.range(8_000).select(
        F.concat(F.lit("c"), (n % 500).cast("string")).alias("t"), F.date_add(F.lit("2024-01-01").cast("date"), (n % 300).cast("int")).alias("d"),
        F.when(n % 4 > 0, n).alias("v"), F.lit(1).alias("same"),
    )
    places = frame.select(curve(frame, ["d", "v"], bits=3).alias("p")).groupBy("p").count().collect()
    assert {r.p for r in places} <= set(range(64)) and max(r["count"] for r in places) < 0.2 * 8_000
    assert frame.select(curve(frame, ["same"]).alias("p")).distinct().count() == 1
    table = RangedTable(spark, str(tmp_path / "t"))
    table.write(frame, ["t", "d"], files=10)
    assert table.read(frame.schema, {"t": ["c17"]}).count() == 16
    empty = RangedTable(spark, str(tmp_path / "e"))
    empty.write(frame.limit(0), ["t", "v"])
    assert empty.read(frame.schema, {"t": ["c1"]}).count() == 0
