"""Staging files as a stream."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from chronostrata.operators.rows import with_reject_reason


def stream_stage(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", files_per_batch: int | None = None,
    **options: str,
) -> DataFrame:
    """New files of a folder, in the order they arrived."""
    reader = spark.readStream.schema(schema).options(**options)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.format(fmt).load(path)


def clean_stream(staged: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Rows with `reject_reason`, NULL where all rules hold."""
    return with_reject_reason(staged, rules)


def drop_repeats(events: DataFrame, keys: list[str], ts_col: str, delay: str) -> DataFrame:
    """Repeated events by key, as far apart as `delay`. Older repeats need `insert_if_absent`."""
    # A watermark takes zoned time only.
    timed = events.withColumn("_event_time", F.col(ts_col).cast("timestamp"))
    return timed.withWatermark("_event_time", delay).dropDuplicatesWithinWatermark(keys).drop("_event_time")


def write_stream(df: DataFrame, path: str, checkpoint: str, partition_by: str | None = None) -> StreamingQuery:
    """Append everything there is to a parquet folder, exactly once, then stop."""
    writer = df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    return writer.trigger(availableNow=True).start(path)
