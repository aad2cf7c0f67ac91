"""Incremental processing: resumable file streams and event-time windows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


def hourly(events: DataFrame, late: str | None = None) -> DataFrame:
    """Events and the sum of their values for each hour and type; ``late`` is a stream's watermark."""
    rows = events.withColumn("ts", F.col("ts").cast("timestamp"))
    rows = rows.withWatermark("ts", late) if late else rows
    sums = rows.groupBy(F.window("ts", "1 hour").alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return sums.select(F.col("w.start").cast("timestamp_ntz").alias("window_start"), "event_type", "n", "total")


def file_stream(spark: SparkSession, path: str, schema: StructType, files_per_batch: int = 100) -> DataFrame:
    """New Parquet files of a folder as a stream."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def run_available(stream: DataFrame, step: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Process everything that is there, then stop; a later call goes on from the checkpoint."""
    return stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
