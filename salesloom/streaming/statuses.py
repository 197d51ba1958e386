"""Delivery outcomes per channel of a lead: the latest status, from events in any order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from salesloom import fixed_values as fv
from salesloom.sources.versions import BUCKETS, BucketTable
from salesloom.streaming.files import triggered
from salesloom.streaming.state import keyed_state

OUTCOMES = T.StructType(
    [
        T.StructField("lead_id", T.StringType()),
        T.StructField("channel", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("changed_at", T.TimestampNTZType()),
    ]
)
LATEST = T.StructType([*OUTCOMES, T.StructField("queued_at", T.TimestampNTZType())])


def _rank(status: Column) -> Column:
    """Of two outcomes of the same moment the one that is further on counts; unknown ones come first."""
    return F.coalesce(F.array_position(F.array(*[F.lit(s) for s in fv.DELIVERY_STATUSES]), status), F.lit(0))


def latest_outcomes(events: DataFrame) -> DataFrame:
    """The latest status per lead and channel, and when it was queued first.

    Repeated and late events change nothing that is already later: the same whatever their order.
    Events without a lead, channel or time are left out.
    """
    known = events.dropna(subset=["lead_id", "channel", "changed_at"])
    latest = F.max(F.struct("changed_at", _rank(F.col("status")).alias("rank"), "status"))
    return known.groupBy("lead_id", "channel").agg(
        latest.alias("latest"),
        F.min(F.when(F.col("status") == fv.DELIVERY_STATUSES[0], F.col("changed_at"))).alias("queued_at"),
    ).select("lead_id", "channel", F.col("latest.status").alias("status"), F.col("latest.changed_at").alias("changed_at"), "queued_at")


def status_table(spark: SparkSession, path: str, buckets: int = BUCKETS) -> BucketTable:
    return BucketTable(spark, path, LATEST, "lead_id", buckets)


def lead_statuses(latest: DataFrame, channels: Sequence[str] = fv.DELIVERY_CHANNELS) -> DataFrame:
    """One row per lead with a status column per channel; a channel without an outcome is queued."""
    columns = [
        F.coalesce(F.max(F.when(F.col("channel") == c, F.col("status"))), F.lit(fv.DELIVERY_STATUSES[0])).alias(f"{c}_status") for c in channels
    ]
    return latest.groupBy("lead_id").agg(*columns)


def start_statuses(
    events: DataFrame, path: str, checkpoint: str, interval: str | None = None, buckets: int = BUCKETS
) -> StreamingQuery:
    """Keep the latest outcome per lead and channel up to date.

    The aggregate is the state (RocksDB, without a watermark: an outcome may come on any day). Each
    batch gives the rows that it changed, and only their buckets of the table are written anew. A batch
    that runs again writes the same version.
    """
    spark = events.sparkSession
    table = status_table(spark, path, buckets)
    table.create(spark.createDataFrame([], LATEST))

    def apply(batch: DataFrame, batch_id: int) -> None:
        touched = table.touched(batch)
        kept = table.read(batch_id, touched).join(batch.select("lead_id", "channel"), ["lead_id", "channel"], "left_anti")
        table.replace(batch_id, batch_id + 1, touched, kept.unionByName(batch))
        table.vacuum()

    with keyed_state(spark):
        writer = latest_outcomes(events).writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).outputMode("update")
        return triggered(writer, interval).start()
