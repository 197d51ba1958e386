"""Order report per day, channel, city and department, in a heavy and a lean form.

The two are different questions, not two plans for one question: the heavy form averages
line items and leaves out orders without an accepted product, the lean one averages orders.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesloom import fixed_values as fv
from salesloom.functions.numbers import from_units, long_sum, money, ratio
from salesloom.functions.periods import moment_lit

_ORDER_COLUMNS = ("order_id", "customer_id", "created_at", "channel", "city", "manager_id")
_DIMENSIONS = ("order_date", "channel", "city", "department")


def _line_amount():
    return F.col("quantity") * F.col("price") - F.col("discount")


def _period_orders(orders: DataFrame, date_from: str, date_to: str) -> DataFrame:
    """A half-open range on the bare column, so it reaches the Parquet scan."""
    created = F.col("created_at")
    return orders.filter((created >= moment_lit(date_from)) & (created < moment_lit(date_to)))


def _order_dims(orders: DataFrame, managers: DataFrame) -> DataFrame:
    departments = managers.select("manager_id", "department")
    return orders.withColumn("order_date", F.to_date("created_at")).join(departments, "manager_id", "left")


def orders_report(
    orders: DataFrame,
    items: DataFrame,
    managers: DataFrame,
    date_from: str,
    date_to: str,
    statuses: Sequence[str] = fv.REPORT_ORDER_STATUSES,
    products: DataFrame | None = None,
    exclude_categories: Sequence[str] = (),
) -> DataFrame:
    """Revenue per order first, then the report.

    With ``exclude_categories`` only items of products outside these categories count.
    Items meet the period's orders before anything is summed, so only the items of the
    period are shuffled further; the sum per order is combined on the map side.
    """
    chosen = _period_orders(orders, date_from, date_to).filter(F.col("status").isin(*statuses))
    chosen = chosen.select(*_ORDER_COLUMNS)
    lines = items.join(chosen.select("order_id"), "order_id", "left_semi")
    if exclude_categories:
        accepted = products.filter(~F.col("category").isin(*exclude_categories)).select("product_id")
        lines = lines.join(accepted, "product_id", "left_semi")
    per_order = lines.groupBy("order_id").agg(F.sum(money(_line_amount())).alias("order_revenue"))
    report = (
        _order_dims(chosen, managers)
        .join(per_order, "order_id")
        .groupBy(*_DIMENSIONS)
        .agg(
            F.count(F.lit(1)).alias("orders"),
            F.sum("order_revenue").alias("total"),
            F.count_distinct("customer_id").alias("customers"),
        )
    )
    return report.select(
        *_DIMENSIONS,
        "orders",
        from_units("total").alias("revenue"),
        ratio(from_units("total", 4), "orders", digits=2).alias("avg_order_revenue"),
        "customers",
    ).orderBy("order_date", F.col("revenue").desc(), "channel", "city", "department")


def orders_report_heavy(
    orders: DataFrame,
    items: DataFrame,
    products: DataFrame,
    managers: DataFrame,
    date_from: str,
    date_to: str,
    statuses: Sequence[str] = fv.REPORT_ORDER_STATUSES,
    exclude_categories: Sequence[str] = fv.EXCLUDED_CATEGORIES,
    paid_status: str = "paid",
) -> DataFrame:
    """The item-level report with the number of paid orders of the same day.

    An order counts only with an item of a known product outside ``exclude_categories``.
    The lookups that give no column (customers, channels, cities) are not joined, and the
    count per day is one grouped table instead of a subquery per row.
    """
    period = _period_orders(orders, date_from, date_to)
    paid_per_day = (
        period.filter(F.col("status") == paid_status)
        .groupBy(F.to_date("created_at").alias("order_date"))
        .agg(F.count_distinct("order_id").alias("paid_orders_same_day"))
    )
    chosen = period.filter(F.lower("status").isin(*statuses)).select(*_ORDER_COLUMNS)
    accepted = products.filter(~F.col("category").isin(*exclude_categories)).select("product_id")
    per_order = (
        items.join(chosen.select("order_id"), "order_id", "left_semi")
        .join(accepted, "product_id")
        .groupBy("order_id")
        .agg(F.sum(money(_line_amount())).alias("amount"), F.count(_line_amount()).alias("lines"))
    )
    report = (
        _order_dims(chosen, managers)
        .join(per_order, "order_id")
        .groupBy(*_DIMENSIONS)
        .agg(
            F.count(F.lit(1)).alias("orders"),
            F.sum("amount").alias("total"),
            long_sum("lines").alias("lines"),
            F.count_distinct("customer_id").alias("customers"),
        )
    )
    return (
        report.join(paid_per_day, "order_date", "left")
        .select(
            *_DIMENSIONS,
            "orders",
            from_units("total").alias("revenue"),
            ratio(from_units("total", 4), "lines", digits=2).alias("avg_item_revenue"),
            "customers",
            F.coalesce("paid_orders_same_day", F.lit(0)).alias("paid_orders_same_day"),
        )
        .orderBy("order_date", F.col("revenue").desc(), "channel", "city", "department")
    )
