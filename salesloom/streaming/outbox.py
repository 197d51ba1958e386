"""Notification run: queued events become outbox messages, each event id once."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from salesloom.plans.notifications import mark_sent, outbox, queued_events
from salesloom.streaming.files import ensure_table, triggered
from salesloom.streaming.state import keyed_state

MESSAGE = T.StructType(
    [
        T.StructField("event_id", T.StringType()),
        T.StructField("created_at", T.TimestampNTZType()),
        T.StructField("channel", T.StringType()),
        T.StructField("responsible", T.StringType()),
        T.StructField("priority_sort", T.IntegerType()),
        T.StructField("text", T.StringType()),
    ]
)
OUTBOX = T.StructType([*MESSAGE, T.StructField("batch", T.LongType())])


def read_outbox(spark, path: str) -> DataFrame:
    return spark.read.schema(OUTBOX).parquet(path)


class FirstMessage(StatefulProcessor):
    """Passes on the earliest message of an event id and remembers the id; every later one is dropped."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "sent boolean")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        earliest = None
        for part in rows:
            if self.seen.exists():
                continue
            best = part.sort_values([c for c in MESSAGE.fieldNames() if c != "event_id"], kind="stable").head(1)
            both = best if earliest is None else pd.concat([earliest, best])
            earliest = both.sort_values([c for c in MESSAGE.fieldNames() if c != "event_id"], kind="stable").head(1)
        if earliest is not None:
            self.seen.update((True,))
            yield earliest

    def close(self) -> None:
        pass


def start_outbox(
    events: DataFrame, rules: DataFrame, path: str, checkpoint: str, interval: str | None = None
) -> StreamingQuery:
    """Write the messages of new events, one folder per batch.

    Of several rows of an id in a batch the earliest counts. The ids that were sent are state, one
    flag each, in RocksDB: a batch looks up its own ids only, on whatever day an event comes again, and Spark
    compacts the store and removes old snapshots. So no event is lost to a watermark, and small
    batches leave one small file each. State and batch are committed together, and a batch that
    runs again replaces its own folder with the same rows.
    """
    ensure_table(events.sparkSession, path, OUTBOX)
    messages = outbox(queued_events(events, rules)).select(*MESSAGE.fieldNames())
    first = messages.groupBy("event_id").transformWithStateInPandas(FirstMessage(), MESSAGE, "append", "none")

    def write(batch: DataFrame, batch_id: int) -> None:
        # The stream's own session: its plans are adaptive only where a batch is written.
        batch.sparkSession.conf.set("spark.sql.adaptive.enabled", "true")
        batch.hint("rebalance").write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    with keyed_state(events.sparkSession):
        writer = first.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).outputMode("append")
        return triggered(writer, interval).start()


def events_with_status(events: DataFrame, path: str) -> DataFrame:
    """The event log with every event of the outbox marked as sent."""
    return mark_sent(events, read_outbox(events.sparkSession, path))
