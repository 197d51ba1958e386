"""Session factory."""

from __future__ import annotations

import re
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings the marts are written for. Shuffle partitions start high and AQE merges
# the small ones, so the same job fits a laptop and a large cluster.
RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split hot keys also where the next operator then needs a shuffle of its own.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}
# How much a task reads, at most. Tables and shuffles are compressed and hold narrow rows, which take
# ten times the room and more in a hash table or sort; with the limits Spark comes with, tasks grow to
# gigabytes with the input before tasks are added.
TASK_SIZES = {
    "spark.sql.files.maxPartitionBytes": "32m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
}
DEFAULTS = {
    **RUNTIME,
    **TASK_SIZES,
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(app_name: str = "salesloom", master: str | None = None, **conf: str) -> SparkSession:
    """Create (or reuse) a session. Extra settings win over ``DEFAULTS``."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session made elsewhere. Smaller tasks of its own stay."""
    for key, value in RUNTIME.items():
        spark.conf.set(key, value)
    for key, value in TASK_SIZES.items():
        if _in_bytes(spark.conf.get(key)) > _in_bytes(value):
            spark.conf.set(key, value)
    return spark


def _in_bytes(size: str) -> int:
    number, unit = re.fullmatch(r"(\d+)\s*([a-z]?)b?", size.strip().lower()).groups()
    return int(number) << {"": 0, "b": 0, "k": 10, "m": 20, "g": 30, "t": 40, "p": 50}[unit]


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Settings for what runs or starts inside; the session's own come back."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
