"""Ordered rule lists: classification of a row, and alert rows from one row of KPIs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_match(rules: Sequence[tuple[Column, Column | str]], otherwise: Column | str | None = None) -> Column:
    """Value of the first rule whose condition holds."""
    result = None
    for condition, value in rules:
        value = value if isinstance(value, Column) else F.lit(value)
        result = F.when(condition, value) if result is None else result.when(condition, value)
    if otherwise is None:
        return result
    return result.otherwise(otherwise if isinstance(otherwise, Column) else F.lit(otherwise))


def joined_reasons(reasons: dict[str, str], separator: str = "; ") -> Column:
    """Texts of all boolean columns that are true, in the order given."""
    return F.concat_ws(separator, *[F.when(F.col(flag), F.lit(text)) for flag, text in reasons.items()])


def alert_rows(kpis: DataFrame, rules: Sequence[tuple[str, Column, Column]], none_text: str) -> DataFrame:
    """One row ``(position, code, message)`` per rule that holds, or one "none" row.

    ``kpis`` has one row of metrics; ``rules`` holds ``(code, condition, message)``.
    """
    found = [
        F.when(
            condition,
            F.struct(F.lit(i).alias("position"), F.lit(code).alias("code"), message.alias("message")),
        )
        for i, (code, condition, message) in enumerate(rules, start=1)
    ]
    alerts = F.array_compact(F.array(*found))
    default = F.array(
        F.struct(F.lit(0).alias("position"), F.lit("none").alias("code"), F.lit(none_text).alias("message"))
    )
    return kpis.select(F.inline(F.when(F.size(alerts) > 0, alerts).otherwise(default)))
