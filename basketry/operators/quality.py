"""Declared data tests and a gate that stops the job."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.operators.distinct import repeated


class DataQualityError(Exception):
    """Raised with every failed check in the message."""


@dataclass(frozen=True)
class DataTest:
    model: str
    column: str
    kind: str  # unique, not_null or accepted_values
    values: tuple[str, ...] = ()


@dataclass(frozen=True)
class Expectation:
    """`metric` is an aggregate over one table, compared with `bound` by == or >=."""

    name: str
    table: str
    metric: Column
    relation: str
    bound: int


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def duplicate_keys(df: DataFrame, column: str) -> DataFrame:
    """Keys that occur more than once, NULL ignored; whole numbers by ranges, without shuffling them."""
    if isinstance(df.schema[column].dataType, (T.IntegerType, T.LongType)):
        return repeated(df, column)
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("copies"))
    return counts.where("copies > 1")


def _tall(wide: DataFrame, names: Sequence[Mapping[str, str]], value: str) -> DataFrame:
    """One row per measured column of a one-row frame, each with its fixed describing columns."""
    rows = [
        F.struct(*(F.lit(v).alias(k) for k, v in name.items()), F.col(f"_{i}").alias(value))
        for i, name in enumerate(names)
    ]
    return wide.select(F.inline(F.array(*rows)))


def run_data_tests(models: Mapping[str, DataFrame], tests: Sequence[DataTest]) -> DataFrame:
    """Failures per test. NULL and value tests of one model share a single aggregate over it."""
    frames = []
    for model in dict.fromkeys(t.model for t in tests):
        df = models[model]
        rowwise = [t for t in tests if t.model == model and t.kind != "unique"]
        bad = [
            F.col(t.column).isNull() if t.kind == "not_null" else ~F.col(t.column).isin(*t.values)
            for t in rowwise
        ]
        if rowwise:
            wide = df.agg(*(F.count_if(b).alias(f"_{i}") for i, b in enumerate(bad)))
            labels = [{"model": t.model, "column_name": t.column, "test": t.kind} for t in rowwise]
            frames.append(_tall(wide, labels, "failures"))
        for t in tests:
            if t.model == model and t.kind == "unique":
                label = {"model": t.model, "column_name": t.column, "test": t.kind}
                count = duplicate_keys(df, t.column).agg(F.count(F.lit(1)).alias("_0"))
                frames.append(_tall(count, [label], "failures"))
    return _union(frames).withColumn("passed", F.col("failures") == 0)


def gate_report(tables: Mapping[str, DataFrame], expectations: Sequence[Expectation]) -> DataFrame:
    """Observed metric and verdict per expectation; one aggregate per table."""
    frames = []
    for table in dict.fromkeys(e.table for e in expectations):
        mine = [e for e in expectations if e.table == table]
        wide = tables[table].agg(*(e.metric.cast("bigint").alias(f"_{i}") for i, e in enumerate(mine)))
        labels = [{"check_name": e.name, "relation": e.relation, "bound": e.bound} for e in mine]
        frames.append(_tall(wide, labels, "observed"))
    met = F.when(F.col("relation") == "==", F.col("observed") == F.col("bound")).otherwise(
        F.col("observed") >= F.col("bound")
    )
    return _union(frames).select(
        "check_name", "relation", F.col("bound").cast("bigint").alias("bound"), "observed", met.alias("passed")
    )


def assert_quality(report: DataFrame) -> None:
    """Raise with all failures of a gate report (as many rows as there are checks)."""
    failed = report.where(~F.col("passed")).orderBy("check_name").collect()
    if failed:
        lines = [f"{r.check_name}: got {r.observed}, expected {r.relation} {r.bound}" for r in failed]
        raise DataQualityError("data quality checks failed:\n" + "\n".join(lines))
