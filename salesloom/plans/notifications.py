"""Internal notifications: queue, message texts, sent marks, summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesloom import fixed_values as fv
from salesloom.operators.upsert import set_status


def _mapped(column: str, mapping: dict, default) -> Column:
    pairs = [F.lit(x) for pair in mapping.items() for x in pair]
    return F.coalesce(F.element_at(F.create_map(*pairs), F.col(column)), F.lit(default))


def queued_events(events: DataFrame, rules: DataFrame) -> DataFrame:
    """Queued events of an enabled type with the rank of their priority."""
    active = rules.filter("enabled = 1").select("event_type").distinct()
    return (
        events.filter("status = 'queued'")
        .join(active, "event_type", "left_semi")
        .withColumn("priority_sort", _mapped("priority", fv.PRIORITY_RANK, fv.PRIORITY_RANK_OTHER))
    )


def notification_queue(events: DataFrame, rules: DataFrame) -> DataFrame:
    """The queue in sending order: priority, then time."""
    return queued_events(events, rules).orderBy("priority_sort", "created_at", "event_id")


def message_text() -> Column:
    mark = _mapped("priority", fv.PRIORITY_MARK, fv.PRIORITY_MARK_OTHER)
    return F.format_string(
        fv.NOTIFICATION_TEXT, mark, "title", "event_type", "entity_id", "responsible", "priority", "message"
    )


def outbox(queue: DataFrame) -> DataFrame:
    """Rendered messages; a delivery job picks them up, nothing is sent from here."""
    return queue.select("event_id", "created_at", "channel", "responsible", "priority_sort", message_text().alias("text"))


def mark_sent(events: DataFrame, sent: DataFrame) -> DataFrame:
    """Every row of a processed event id becomes ``sent``."""
    return set_status(events, sent, "event_id", "sent")


def daily(events: DataFrame) -> DataFrame:
    grouped = events.groupBy(F.to_date("created_at").alias("date"), "event_type", "priority", "status").agg(
        F.count(F.lit(1)).alias("events")
    )
    return grouped.orderBy(F.col("date").desc(), F.col("events").desc(), "event_type", "priority", "status")


def summary(events: DataFrame) -> DataFrame:
    keys = ["event_type", "priority", "status"]
    grouped = events.dropna(subset=keys).groupBy(*keys).agg(F.count("event_id").alias("events_count"))
    return grouped.orderBy(F.col("events_count").desc(), *keys)
