"""Shared pieces of the streaming jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter


def landed_json(spark: SparkSession, folder: str, schema: T.StructType, files_per_batch: int | None = None) -> DataFrame:
    """Stream of JSON-lines files that arrive in a folder."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(folder)


def triggered(writer: DataStreamWriter, interval: str | None) -> DataStreamWriter:
    """Run every ``interval``, or work through what has arrived and stop."""
    return writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)


def ensure_table(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """Create an empty table folder where there is none; leaves existing data alone."""
    spark.createDataFrame([], schema).write.mode("append").parquet(path)
