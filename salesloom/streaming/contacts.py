"""Incremental contact upsert in versions of the contact table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from salesloom.operators.upsert import upsert
from salesloom.plans.contacts import UPDATED, ready_contacts, with_location
from salesloom.sources.versions import BUCKETS, BucketTable, child_folders, remove_folder
from salesloom.streaming.files import triggered

KEPT = 2  # versions: the last one and the one before, which a repeated batch reads


def contact_table(spark: SparkSession, path: str, schema: T.StructType, buckets: int = BUCKETS) -> BucketTable:
    return BucketTable(spark, path, schema, "number", buckets)


def read_version(spark: SparkSession, path: str, version: int, schema: T.StructType) -> DataFrame:
    return contact_table(spark, path, schema).read(version)


def read_pending(spark: SparkSession, pending: str, version: int, schema: T.StructType) -> DataFrame:
    """The sheet rows that wait for a position after ``version`` (none before the first)."""
    if version not in child_folders(spark, pending, "version"):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{pending}/version={version}")


def retried(waiting: DataFrame, replies: DataFrame | None) -> DataFrame:
    """Waiting rows with the newest geocoder reply to their address; a row without a new one keeps its own.

    ``replies``: address, geocoder_reply, replied_at.
    """
    if replies is None:
        return waiting
    newest = replies.groupBy("address").agg(F.max_by("geocoder_reply", "replied_at").alias("_reply"))
    asked = ready_contacts(waiting).select(*waiting.columns, "address").join(newest, "address", "left")
    return asked.withColumn("geocoder_reply", F.coalesce("_reply", "geocoder_reply")).select(*waiting.columns)


def start_upserts(
    sheet: DataFrame,
    initial: DataFrame,
    path: str,
    pending: str,
    checkpoint: str,
    interval: str | None = None,
    replies: DataFrame | None = None,
    buckets: int = BUCKETS,
) -> StreamingQuery:
    """Apply each batch of ready rows to the contact table.

    Batch ``n`` reads version ``n`` and writes version ``n + 1``, so a batch that runs again
    gives the same table; only the hash buckets of its numbers are read and written. Rows without a position wait in
    ``pending``: the next batch tries them again, with the newest of ``replies`` to their
    address. A waiting row gives way to a later row of its number. The version before the last is kept, older ones are removed.
    """
    spark = sheet.sparkSession
    columns = initial.columns
    table = contact_table(spark, path, initial.schema, buckets)
    table.create(initial)

    def apply(batch: DataFrame, batch_id: int) -> None:
        waiting = read_pending(spark, pending, batch_id, batch.schema)
        # Which rows have a position is decided once: a reply may come while the batch runs.
        tried = f"{pending}/tried"
        ready = ready_contacts(retried(waiting, replies).unionByName(batch.filter(F.lower("status") == "ready")))
        with_location(ready).write.mode("overwrite").parquet(tried)
        rows = spark.read.parquet(tried)
        found = F.col("lon").isNotNull() & F.col("lat").isNotNull()
        last = rows.groupBy("number").agg(F.max("row_no").alias("_last"), F.max(F.when(found, F.col("row_no"))).alias("_located"))
        known = rows.join(last, "number")
        # The last row of a number waits if it has no position and no later one has.
        open_ = known.filter(~found & (F.col("row_no") == F.col("_last")) & (F.col("_located").isNull() | (F.col("_located") < F.col("row_no"))))
        open_.select(*batch.columns).write.mode("overwrite").parquet(f"{pending}/version={batch_id + 1}")
        located = rows.filter(found).select(*columns, "row_no")
        touched = table.touched(located)
        merged = upsert(table.read(batch_id, touched), located, "number", UPDATED, order="row_no")
        table.replace(batch_id, batch_id + 1, touched, merged.select(*columns))
        table.vacuum(KEPT)
        for old in child_folders(spark, pending, "version"):
            if old <= batch_id + 1 - KEPT:
                remove_folder(spark, f"{pending}/version={old}")

    writer = sheet.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    return triggered(writer, interval).start()
