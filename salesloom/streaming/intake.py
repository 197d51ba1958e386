"""Intake of lead forms: valid leads and quarantined forms go to two tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from salesloom.plans.leads import accepted, quarantined, validate_leads
from salesloom.streaming.files import triggered


def start_intake(
    forms: DataFrame, leads_path: str, quarantine_path: str, checkpoint: str, interval: str | None = None
) -> list[StreamingQuery]:
    """Start both branches. The file sink commits each batch once, also after a restart."""
    validated = validate_leads(forms)
    queries = []
    for name, branch, path in (
        ("leads", accepted(validated), leads_path),
        ("quarantine", quarantined(validated), quarantine_path),
    ):
        writer = branch.writeStream.format("parquet").option("path", path).option("checkpointLocation", f"{checkpoint}/{name}")
        queries.append(triggered(writer, interval).start())
    return queries
