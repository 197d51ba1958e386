"""Parametric charts: a metric per period, its change, and the plan/fact table.

Their formulas exist in prose only. Choices made here: the change follows the day-over-day
rule (0 when both are 0, +100 when only the previous is 0); the buy-out rate is paid units
by ordered units; a plan is the daily plan times the days of the period up to the as-of day.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesloom.functions.numbers import delta_pct, long_sum, money_sum, ratio
from salesloom.functions.periods import as_date, date_lit, period_start

METRICS = ("visits", "orders", "revenue", "units", "installs", "buyout_rate")
DYNAMICS = "_dynamics"  # after a metric's name: its change in percent


def _aggregate(name: str) -> Column:
    if name == "revenue":
        return money_sum("revenue")
    if name == "buyout_rate":
        return ratio(long_sum("paid_units"), long_sum("units"), digits=4)
    return long_sum(name).cast("double")


def metrics_by_period(df: DataFrame, grain: str, metrics: Sequence[str] = METRICS) -> DataFrame:
    """Long table ``(period, metric, value)`` for one time grain.

    ``df`` has a ``date`` column and one column per metric; all metrics take one pass.
    """
    unknown = [m for m in metrics if m not in METRICS]
    if unknown:
        raise ValueError(f"unknown metrics: {unknown}")
    wide = df.groupBy(period_start("date", grain).alias("period")).agg(*[_aggregate(m).alias(m) for m in metrics])
    pairs = F.inline(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in metrics]))
    return wide.select("period", pairs)


def metric_by_period(df: DataFrame, grain: str, metric: str) -> DataFrame:
    """The chart with both parameters chosen: ``(period, value)``.

    ``metric`` is one of ``METRICS``, or such a name with ``DYNAMICS`` behind it, for instance visits_dynamics.
    """
    if metric.endswith(DYNAMICS):
        changes = metric_dynamics(df, grain, [metric.removesuffix(DYNAMICS)])
        return changes.select("period", F.col("dynamics_pct").alias("value")).orderBy("period")
    return metrics_by_period(df, grain, [metric]).select("period", "value").orderBy("period")


def metric_dynamics(df: DataFrame, grain: str, metrics: Sequence[str] = METRICS) -> DataFrame:
    """Value and change in percent against the period before that has data.

    The window runs over aggregated rows, one per calendar period and metric.
    """
    earlier = Window.partitionBy("metric").orderBy("period")
    values = metrics_by_period(df, grain, metrics).withColumn("prev_value", F.lag("value").over(earlier))
    return values.withColumn("dynamics_pct", delta_pct("value", "prev_value", digits=4))


def plan_fact(fact: DataFrame, plan: DataFrame, start, end, as_of, vat: float = 1.0) -> DataFrame:
    """Budget, revenue and their ratio by channel, plan against fact, with a Total row.

    Channels with a plan but no facts, and the reverse, stay in the table.
    """
    days = max((min(as_date(end), as_date(as_of)) - as_date(start)).days + 1, 0)
    in_period = F.col("date").between(as_date(start), as_date(end)) & (F.col("date") <= date_lit(as_of))
    facts = (
        fact.filter(in_period)
        .groupBy("channel")
        .agg(money_sum("cost").alias("cost"), money_sum("revenue").alias("revenue_fact"))
        .withColumn("budget_fact", F.col("cost") * F.lit(float(vat)))
    )
    plans = plan.select(
        "channel",
        (F.col("day_total_cost") * days).alias("budget_plan"),
        (F.col("day_revenue_plan") * days).alias("revenue_plan"),
    )
    amounts = ("budget_plan", "budget_fact", "revenue_plan", "revenue_fact")
    table = plans.join(facts, "channel", "full").rollup("channel").agg(
        F.grouping("channel").alias("is_total"), *[money_sum(c).alias(c) for c in amounts]
    )
    return table.select(
        F.when(F.col("is_total") == 1, "Total").otherwise(F.col("channel")).alias("channel"),
        "is_total",
        *amounts,
        ratio("budget_plan", "revenue_plan", digits=4).alias("drr_plan"),
        ratio("budget_fact", "revenue_fact", digits=4).alias("drr_fact"),
    ).orderBy("is_total", "channel")


def split_brand(fact: DataFrame, direct_channel: str, is_brand: Column) -> DataFrame:
    """Rows of the direct channel under "<channel> brand" or "<channel> non-brand"."""
    suffix = F.when(is_brand, " brand").otherwise(" non-brand")
    named = F.when(F.col("channel") == direct_channel, F.concat(F.col("channel"), suffix)).otherwise(F.col("channel"))
    return fact.withColumn("channel", named)

