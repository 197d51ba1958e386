"""Daily sales report: KPIs against the previous day, channels, categories, alerts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesloom import fixed_values as fv
from salesloom.functions import labels
from salesloom.functions.numbers import count_when, delta_pct, long_sum, money_sum, ratio, rounded, sum_if
from salesloom.functions.periods import as_date, date_lit
from salesloom.functions.rules import alert_rows
from salesloom.operators.kpis import day_over_day


def clean_orders(orders: DataFrame) -> DataFrame:
    """Statuses in one spelling, so every later filter is a plain comparison."""
    return orders.withColumn("status", F.lower(F.trim("status")))


def _two_days(orders: DataFrame, report_date) -> DataFrame:
    day = as_date(report_date)
    return clean_orders(orders.filter(F.col("order_date").isin(day, day - dt.timedelta(days=1))))


def _paid() -> Column:
    return F.col("status").isin(*fv.PAID_STATUSES)


def _cancelled() -> Column:
    return F.col("status").isin(*fv.CANCEL_STATUSES)


def _day_row(orders: DataFrame, report_date) -> DataFrame:
    """Totals of both days in one row.

    Rows are combined per order first, so distinct orders are plain counts afterwards.
    """
    per_order = (
        _two_days(orders, report_date)
        .groupBy("order_date", "order_id")
        .agg(
            F.max(_paid()).alias("paid"),
            F.max(_cancelled()).alias("cancelled"),
            sum_if("revenue", _paid()).alias("revenue"),
            count_when(_paid() & F.col("is_new_client")).alias("new_clients"),
        )
    )
    today = F.col("order_date") == date_lit(report_date)
    known = F.col("order_id").isNotNull()
    totals = []
    for prefix, on_day in (("cur", today), ("prev", ~today)):
        totals += [
            sum_if("revenue", on_day).alias(f"{prefix}_revenue"),
            count_when(on_day & F.col("paid") & known).alias(f"{prefix}_orders"),
            long_sum(F.when(on_day, F.col("new_clients"))).alias(f"{prefix}_new_clients"),
            count_when(on_day & F.col("cancelled") & known).alias(f"{prefix}_cancels"),
        ]
    row = per_order.agg(*totals)
    for prefix in ("cur", "prev"):
        row = row.withColumn(f"{prefix}_avg_check", ratio(f"{prefix}_revenue", f"{prefix}_orders", on_zero=0))
    return row


def _kpi_rows(orders: DataFrame, report_date) -> DataFrame:
    spec = {
        key: (F.lit(title), F.col(f"cur_{key}"), F.col(f"prev_{key}"), key != "cancels")
        for key, title in fv.SALES_KPI_TITLES.items()
    }
    return day_over_day(_day_row(orders, report_date), spec)


def daily_kpis(orders: DataFrame, report_date) -> DataFrame:
    """Five KPIs with the previous day and their text form."""
    value = F.col("value")
    text = F.when(F.col("kpi").isin("revenue", "avg_check"), labels.money_label(value)).otherwise(
        labels.number_label(value)
    )
    return _kpi_rows(orders, report_date).select(
        "position",
        "kpi",
        rounded("value", 4).alias("value"),
        rounded("prev_value", 4).alias("prev_value"),
        rounded("delta_pct", 4).alias("delta_pct"),
        text.alias("label"),
        labels.delta_label("value", "prev_value", "delta_pct").alias("delta_label"),
    )


def _paid_breakdown(orders: DataFrame, report_date, key: str) -> DataFrame:
    day = clean_orders(orders.filter(F.col("order_date") == date_lit(report_date)))
    grouped = (
        day.filter(_paid() & F.col(key).isNotNull())
        .groupBy(key)
        .agg(money_sum("revenue").alias("revenue"), F.count_distinct("order_id").alias("orders"))
    )
    return grouped.withColumn("avg_check", ratio("revenue", "orders", digits=4)).orderBy(F.col("revenue").desc(), key)


def by_channel(orders: DataFrame, report_date) -> DataFrame:
    return _paid_breakdown(orders, report_date, "channel")


def by_category(orders: DataFrame, report_date) -> DataFrame:
    return _paid_breakdown(orders, report_date, "category")


def channel_day(orders: DataFrame, report_date) -> DataFrame:
    """Both days by channel and category; new clients are distinct customers here."""
    grouped = (
        _two_days(orders, report_date)
        .groupBy("order_date", "channel", "category")
        .agg(
            F.count_distinct(F.when(_paid(), F.col("order_id"))).alias("orders"),
            sum_if("revenue", _paid()).alias("revenue"),
            F.count_distinct(F.when(_cancelled(), F.col("order_id"))).alias("canceled_orders"),
            F.count_distinct(F.when(_paid() & F.col("is_new_client"), F.col("customer_id"))).alias("new_clients"),
        )
    )
    return grouped.withColumn("avg_check", ratio("revenue", "orders", digits=2)).orderBy(
        "order_date", F.col("revenue").desc(), "channel", "category"
    )


def sales_alerts(orders: DataFrame, report_date) -> DataFrame:
    row = _day_row(orders, report_date)

    def change(name: str) -> Column:
        return delta_pct(f"cur_{name}", f"prev_{name}")

    more_cancels = (F.col("cur_cancels") > F.col("prev_cancels")) & (F.col("cur_cancels") >= 3)
    conditions = {
        "revenue_down": change("revenue") <= -15,
        "orders_down": change("orders") <= -15,
        "avg_check_down": change("avg_check") <= -10,
        "cancels_up": more_cancels,
    }
    rules = [(code, condition, F.lit(fv.SALES_ALERTS[code])) for code, condition in conditions.items()]
    return alert_rows(row, rules, fv.SALES_ALERTS["none"])
