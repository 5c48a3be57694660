"""CSV, Parquet, catalog tables and JDBC."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.sources.schemas import CSV_FILES, RAW


def _typed(name: str, kind: T.DataType) -> Column:
    """Cast a CSV text field; a field that does not parse becomes NULL instead of ending the job."""
    text = F.trim(F.col(name))
    if isinstance(kind, T.StringType):
        return F.col(name)
    if isinstance(kind, T.IntegerType):
        # Whole numbers may arrive as "34.0" where the column also has blanks.
        return F.floor(text.try_cast("decimal(20,4)")).try_cast("int").alias(name)
    if isinstance(kind, T.BooleanType):
        return F.coalesce(text.try_cast("boolean"), F.lit(True)).alias(name)
    if isinstance(kind, T.DateType):
        return F.coalesce(text.try_cast("date"), F.substr(text, F.lit(1), F.lit(10)).try_cast("date")).alias(name)
    return text.try_cast(kind).alias(name)


def cast_columns(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Give text columns the types of `schema`. A blank flag counts as true."""
    return df.select(*(_typed(f.name, f.dataType) for f in schema.fields))


# A quote inside a quoted field is doubled.
CSV = {"header": "true", "escape": '"'}


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType | None = None, multiline: bool = False
) -> DataFrame:
    """CSV with a header line. With a schema the file is read once; without one Spark infers the types.

    `multiline` allows line breaks inside quotes, at the price of one task per file.
    """
    reader = spark.read.options(**CSV).option("multiLine", multiline)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    return cast_columns(reader.schema(text).option("enforceSchema", False).csv(path), schema)


def read_raw(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {name: read_csv(spark, f"{folder}/{CSV_FILES[name]}", schema) for name, schema in RAW.items()}


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header line; timestamps keep their microseconds."""
    micros = "yyyy-MM-dd HH:mm:ss.SSSSSS"
    writer = df.write.mode("overwrite").options(**CSV)
    writer.option("timestampFormat", micros).option("timestampNTZFormat", micros).csv(path)


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> int:
    """Replace a Parquet directory and return the rows written, counted during the write.

    With partition columns the rows are rebalanced on them first: adaptive execution then splits a partition
    that holds most of the rows over several files and merges the small ones.
    """
    seen = Observation()
    # Counted after the shuffle, in the writing stage, where a repeated task is not counted twice.
    spread = df.hint("rebalance", *partition_by) if partition_by else df
    spread.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return seen.get["rows"]


def save_table(df: DataFrame, name: str) -> int:
    """Create or replace a managed table and return the rows written."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").saveAsTable(name)
    return seen.get["rows"]


def write_jdbc(df: DataFrame, url: str, table: str, properties: Mapping[str, str] | None = None) -> None:
    """Replace a table in a relational store."""
    df.write.jdbc(url, table, mode="overwrite", properties=dict(properties or {}))


def register(tables: Mapping[str, DataFrame]) -> None:
    """Make DataFrames available to SQL by name."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
