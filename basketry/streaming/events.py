"""Event cleaning on files as they arrive. The projection is the batch one and keeps no state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from basketry.plans.staging import fct_events
from basketry.sources.schemas import RAW
from basketry.sources.tables import CSV, cast_columns


def read_event_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Raw events from CSV files dropped into a folder."""
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in RAW["raw_events"].fields])
    files = spark.readStream.schema(text).options(**CSV).csv(folder)
    return cast_columns(files, RAW["raw_events"])


def write_event_stream(events: DataFrame, folder: str, checkpoint: str) -> StreamingQuery:
    """Append cleaned events to a Parquet directory; processes what is there and stops."""
    writer = fct_events(events).writeStream.format("parquet").option("checkpointLocation", checkpoint)
    return writer.partitionBy("event_date").trigger(availableNow=True).start(folder)
