"""Wide one-row KPI tables turned into long ones, and calendar deltas."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesloom.functions.numbers import delta_pct, is_good


def to_long(row: DataFrame, names: Sequence[str], name: str = "metric", value: str = "value", cast: str = "double") -> DataFrame:
    """Turn the named columns of each row into ``(name, value)`` rows."""
    pairs = [F.struct(F.lit(n).alias(name), F.col(n).cast(cast).alias(value)) for n in names]
    return row.select(F.inline(F.array(*pairs)))


def day_over_day(row: DataFrame, kpis: dict[str, tuple[Column, Column, Column, bool]]) -> DataFrame:
    """Long KPI table from one row that holds both days.

    ``kpis`` maps a key to ``(title, current, previous, higher_is_better)``.
    Output: position, kpi, title, value, prev_value, delta_pct, is_good.
    """
    rows = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(key).alias("kpi"),
            title.alias("title"),
            current.cast("double").alias("value"),
            previous.cast("double").alias("prev_value"),
            F.lit(better).alias("higher_is_better"),
        )
        for i, (key, (title, current, previous, better)) in enumerate(kpis.items(), start=1)
    ]
    long = row.select(F.inline(F.array(*rows)))
    delta = delta_pct("value", "prev_value")
    return long.withColumn("delta_pct", delta).withColumn("is_good", is_good("delta_pct", F.col("higher_is_better")))
