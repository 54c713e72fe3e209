"""Incremental intake of metadata and events with Structured Streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.hygiene import status_of


def file_stream(spark: SparkSession, path: str, schema, per_trigger: int = 100) -> DataFrame:
    """New Parquet files of a folder, some at a time."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_trigger).parquet(path)


def deduplicated(stream: DataFrame, key: list[str], time: str, delay: str = "1 hour") -> DataFrame:
    """First row of each key; keys are forgotten once the watermark has passed them by delay, so state stays bounded."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(key)


def windowed_counts(stream: DataFrame, time: str, key: str, width: str = "1 hour", delay: str = "1 hour") -> DataFrame:
    """Rows of each key in tumbling windows, given once the watermark has passed a window."""
    return stream.withWatermark(time, delay).groupBy(F.window(time, width), key).agg(F.count(F.lit(1)).alias("n"))


def classified(stream: DataFrame, id_col: str = "id", url: str = "file", length: str = "length") -> DataFrame:
    """Metadata rows with the status that decides whether they are fetched."""
    s = status_of(id_col, url, length)
    return stream.withColumn("_s", s).withColumns({"status": F.col("_s.status"), "error": F.col("_s.error")}).drop("_s")


def append_to(stream: DataFrame, path: str, checkpoint: str, once: bool = True):
    """Append to a Parquet table; each row arrives once, as the checkpoint and the table's own log tell."""
    writer = stream.writeStream.format("parquet").outputMode("append").option("path", path).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
