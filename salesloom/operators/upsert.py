"""Keyed changes of a table: upsert and status transitions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesloom.operators.joins import shuffled_join


def upsert(target: DataFrame, batch: DataFrame, key: str, update_cols: Sequence[str], order: str) -> DataFrame:
    """Merge ``batch`` into ``target``.

    A new key takes the values of its first batch row, an existing one keeps its own; both
    then take ``update_cols`` from the last batch row (by ``order``). That is the outcome of
    applying the rows one by one.
    Both picks are aggregates, so a key with many batch rows is combined before the shuffle.
    """
    columns = [c for c in target.columns if c != key]
    payload = F.struct(*columns)
    merged = batch.groupBy(key).agg(
        F.min_by(payload, F.col(order)).alias("_first"), F.max_by(payload, F.col(order)).alias("_last")
    )
    joined = target.withColumn("_old", F.lit(True)).join(merged, key, "full")
    picked = []
    for name in columns:
        kept = F.when(F.col("_old"), F.col(name)).otherwise(F.col(f"_first.{name}"))
        fresh = F.col("_last").isNotNull()
        value = F.when(fresh, F.col(f"_last.{name}")).otherwise(kept) if name in update_cols else kept
        picked.append(value.alias(name))
    return joined.select(F.col(key), *picked)


def set_status(df: DataFrame, done: DataFrame, key: str, status: str, column: str = "status") -> DataFrame:
    """Give ``status`` to every row whose key occurs in ``done``.

    A key may have any number of rows; AQE may split those of a hot key over tasks.
    """
    ids = done.select(key).distinct().withColumn("_done", F.lit(True))
    changed = F.when(F.col("_done"), F.lit(status)).otherwise(F.col(column))
    return shuffled_join(df, ids, key, "left").withColumn(column, changed).select(*df.columns)
