"""Ad spend, CRM leads and paid orders in one report by day, channel and campaign."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesloom import fixed_values as fv
from salesloom.functions.labels import number_label, plain_label
from salesloom.functions.numbers import count_when, long_sum, money_sum, ratio

_KEYS = ["date", "channel", "campaign"]


def _per_positive(num, den, digits: int) -> Column:
    """A ratio that is 0 unless the denominator is positive."""
    return F.when(F.col(den) > 0, ratio(num, den, digits=digits)).otherwise(F.lit(0.0))


def ad_sales_report(spend: DataFrame, leads: DataFrame, orders: DataFrame) -> DataFrame:
    """Costs against leads and revenue; sales are won leads.

    Leads without an order share one blank order id. They cannot match and are kept out of
    the join's shuffle, so they do not meet in one task.
    """
    spent = spend.groupBy(*_KEYS).agg(
        long_sum("impressions").alias("impressions"), long_sum("clicks").alias("clicks"), money_sum("cost").alias("cost")
    )
    paid = orders.select(
        "order_id", "revenue", (F.col("revenue") * F.col("gross_margin")).alias("gross_profit")
    ).filter("order_id <> ''")
    lead_rows = leads.select(
        F.to_date("created_at").alias("date"), "channel", "campaign", "lead_id", "status", "order_id"
    )
    has_order = F.coalesce(F.col("order_id") != "", F.lit(False))
    matched = lead_rows.filter(has_order).join(paid, "order_id", "left").drop("order_id")
    unmatched = lead_rows.filter(~has_order).drop("order_id")
    won = F.coalesce(F.col("status") == fv.WON_STATUS, F.lit(False))
    gained = (
        matched.unionByName(unmatched, allowMissingColumns=True)
        .dropna(subset=_KEYS)
        .groupBy(*_KEYS)
        .agg(
            F.count_distinct("lead_id").alias("leads"),
            count_when(won).alias("sales"),
            money_sum("revenue").alias("revenue"),
            money_sum("gross_profit").alias("gross_profit"),
        )
    )
    report = spent.dropna(subset=_KEYS).join(gained, _KEYS, "full").fillna(0)
    profit = F.col("gross_profit") - F.col("cost")
    return report.withColumns(
        {
            "ctr": _per_positive("clicks", "impressions", 4),
            "cpl": _per_positive("cost", "leads", 4),
            "cpo": _per_positive("cost", "sales", 4),
            "cr_lead_to_sale": _per_positive("sales", "leads", 4),
            "romi": _per_positive(profit, "cost", 4),
        }
    ).orderBy(*_KEYS)


def channel_summary(report: DataFrame) -> DataFrame:
    """The report summed by channel."""
    grouped = report.groupBy("channel").agg(
        money_sum("cost").alias("cost"),
        long_sum("leads").alias("leads"),
        long_sum("sales").alias("sales"),
        money_sum("revenue").alias("revenue"),
        money_sum("gross_profit").alias("gross_profit"),
    )
    profit = F.col("gross_profit") - F.col("cost")
    return (
        grouped.withColumn("cpl", _per_positive("cost", "leads", 2))
        .withColumn("romi", _per_positive(profit, "cost", 3))
        .orderBy(F.col("cost").desc(), "channel")
    )


def channel_messages(summary: DataFrame) -> DataFrame:
    """One message line per channel."""
    name = F.translate("channel", ",", " ")
    line = F.format_string(
        fv.AD_CHANNEL_LINE, name, number_label("cost"), "leads", "sales", plain_label(F.col("romi") * 100, 1)
    )
    return summary.select("channel", line.alias("message")).orderBy("channel")
