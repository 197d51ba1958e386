"""Marketplace stock control: margin, days of stock, alerts."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesloom import fixed_values as fv
from salesloom.functions.numbers import count_when, long_sum, money_sum, ratio, rounded
from salesloom.functions.periods import as_date
from salesloom.functions.rules import first_match
from salesloom.operators.joins import lookup_join

_COLUMNS = (
    "marketplace", "sku", "product_name", "category", "warehouse", "stock", "reserved", "available_stock",
    "price", "commission_rate", "commission_amount", "net_price", "cost_price", "gross_margin_per_unit",
    "gross_margin_rate", "orders_3d", "revenue_3d", "daily_sales_avg", "days_of_stock", "status", "alert",
)


def stock_union(stocks: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), stocks)


def stock_report(
    stock: DataFrame,
    orders: DataFrame,
    products: DataFrame,
    date_from,
    date_to,
    days: int = 3,
    loaded_at: str | None = None,
) -> DataFrame:
    """One row per marketplace, product and warehouse with its alert.

    Sales are summed over ``date_from..date_to`` and divided by ``days``. A product without
    sales has ``STOCK_NO_SALES_DAYS`` days of stock, also with a negative or empty stock.
    """
    sold = (
        orders.filter(F.col("date").between(as_date(date_from), as_date(date_to)))
        .groupBy("marketplace", "sku")
        .agg(long_sum("orders").alias("orders_3d"), money_sum("revenue").alias("revenue_3d"))
    )
    report = lookup_join(lookup_join(stock, products, ["sku"], check=True), sold, ["marketplace", "sku"])
    report = report.fillna(0, subset=["orders_3d", "revenue_3d"])
    commission = F.col("price") * F.col("commission_rate")
    report = report.withColumn("available_stock", F.col("stock") - F.col("reserved"))
    report = report.withColumn("commission_amount", commission)
    report = report.withColumn("net_price", F.col("price") - F.col("commission_amount"))
    report = report.withColumn("gross_margin_per_unit", rounded(F.col("net_price") - F.col("cost_price"), 2))
    report = report.withColumn("gross_margin_rate", ratio("gross_margin_per_unit", "price", digits=4))
    report = report.withColumn("daily_sales_avg", ratio("orders_3d", F.lit(days), digits=2))
    days_left = ratio("available_stock", "daily_sales_avg", digits=1, on_zero=fv.STOCK_NO_SALES_DAYS)
    report = report.withColumn("days_of_stock", days_left)
    available = F.col("available_stock")
    alert = first_match(
        [
            (available <= 0, "out_of_stock"),
            ((available <= fv.STOCK_LOW_UNITS) | (F.col("days_of_stock") <= fv.STOCK_LOW_DAYS), "reorder"),
            (F.col("gross_margin_rate") < fv.STOCK_MIN_MARGIN_RATE, "low_margin"),
        ],
        otherwise="ok",
    )
    report = report.withColumn("alert", alert).select(*_COLUMNS)
    if loaded_at is not None:
        report = report.withColumn("loaded_at", F.lit(loaded_at).cast("timestamp_ntz"))
    return report


def stock_alerts(report: DataFrame) -> DataFrame:
    return report.filter("alert <> 'ok'").orderBy("alert", "marketplace", "sku", "warehouse")


def stock_summary(report: DataFrame) -> DataFrame:
    grouped = report.groupBy("marketplace").agg(
        F.count_distinct("sku").alias("sku_count"),
        long_sum("available_stock").alias("available_stock"),
        money_sum("revenue_3d").alias("revenue_3d"),
        count_when(F.col("alert") != "ok").alias("alerts_count"),
    )
    return grouped.orderBy(F.col("revenue_3d").desc(), "marketplace")


def alert_messages(report: DataFrame) -> DataFrame:
    """One message line per alert."""
    line = F.format_string(
        fv.STOCK_ALERT_LINE, "marketplace", "sku", "product_name", "available_stock", "alert"
    )
    return stock_alerts(report).select("marketplace", "sku", "warehouse", line.alias("message"))
