"""Flat sales mart: item detail, order sequence, and daily, category and customer metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesloom import fixed_values as fv
from salesloom.functions.numbers import count_when, long_sum, money_sum, ratio, rounded, sum_if
from salesloom.functions.periods import iso_week_label, month_label, weekday_name
from salesloom.operators.joins import hot_from_counts, key_violations, lookup_join, one_row_a_key, spread_join
from salesloom.operators.ranking import number_in_group, number_lines

DETAIL_COLUMNS = (
    "order_date", "order_month", "order_week", "day_of_week", "order_id", "customer_id", "customer_name",
    "city", "customer_type", "sales_channel", "payment_method", "order_status", "manager", "product_id",
    "product_name", "category", "quantity", "unit_price", "discount_pct", "gross_revenue",
    "discount_amount", "net_revenue", "cost", "margin", "margin_pct", "is_paid", "is_cancelled",
    "order_total", "order_margin", "avg_check", "order_sequence", "is_repeat_purchase",
)
SORT_KEYS = ("order_date", "order_id", "product_id")


def price_items(items: DataFrame, products: DataFrame) -> DataFrame:
    """Items with product columns and money per line.

    The discount is rounded first and then taken off the gross amount.
    """
    priced = lookup_join(items, products, ["product_id"], check=True)
    gross = F.col("quantity") * F.col("unit_price")
    priced = priced.withColumn("gross_revenue", gross).withColumn("cost", F.col("quantity") * F.col("unit_cost"))
    priced = priced.withColumn("discount_amount", rounded(F.col("gross_revenue") * F.col("discount_pct"), 2))
    priced = priced.withColumn("net_revenue", rounded(F.col("gross_revenue") - F.col("discount_amount"), 2))
    return priced.withColumn("margin", rounded(F.col("net_revenue") - F.col("cost"), 2))


def order_totals(items: DataFrame, products: DataFrame) -> DataFrame:
    """Net amount, margin and number of lines per order.

    The items are priced and combined before the shuffle.
    """
    return price_items(items, products).groupBy("order_id").agg(
        money_sum("net_revenue").alias("order_total"),
        money_sum("margin").alias("order_margin"),
        F.count(F.lit(1)).alias("lines"),
    )


def order_sequence(orders: DataFrame, totals: DataFrame) -> DataFrame:
    """Orders with items, numbered in the customer's history, with totals and repeat flag.

    Orders without a customer or date are left out.
    """
    dated = orders.filter("customer_id IS NOT NULL AND order_date IS NOT NULL")
    history = dated.select("order_id", "customer_id", "order_date").join(totals.drop("lines"), "order_id")
    numbered = number_in_group(
        history,
        ["customer_id"],
        [F.col("order_date"), F.col("order_id")],
        "order_sequence",
        bucket=F.col("order_date"),
    )
    return numbered.withColumn("is_repeat_purchase", (F.col("order_sequence") > 1).cast("int"))


def item_sequence(
    items: DataFrame,
    orders: DataFrame,
    tiebreak: Sequence[str],
    order_columns: Sequence[str] = ("customer_id", "order_date"),
) -> DataFrame:
    """Number of the *line item* in the customer's history.

    A first order with two items has the numbers 1 and 2, so its second line counts as a
    repeat purchase here; ``order_sequence`` is the form without this effect. Lines are numbered
    inside their order; the lines of the customer's earlier days and orders are added.
    """
    lines = items.join(orders.select("order_id", *order_columns), "order_id", "left")
    numbered = number_lines(lines, "customer_id", ("order_date", "order_id"), tiebreak, "order_sequence")
    return numbered.withColumn("is_repeat_purchase", (F.col("order_sequence") > 1).cast("int"))


def order_flags(df: DataFrame) -> DataFrame:
    """``is_paid`` and ``is_cancelled`` (0 or 1) from the order status; no status is neither."""
    status = F.col("order_status")
    paid = F.coalesce(status.isin(*fv.COUNTED_ORDER_STATUSES), F.lit(False))
    cancelled = F.coalesce(status.isin(*fv.CANCELLED_ORDER_STATUSES), F.lit(False))
    return df.withColumn("is_paid", paid.cast("int")).withColumn("is_cancelled", cancelled.cast("int"))


def sales_detail(items: DataFrame, orders: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """The flat item table for BI (sort it by ``SORT_KEYS`` when writing).

    Customers are looked up on the order table, which is much smaller than the items, and
    the items are shuffled by order only once for all order columns. An order with very many
    lines is split over tasks.
    """
    priced = price_items(items, products)
    totals = order_totals(items, products)
    sequence = order_sequence(orders, totals).drop("customer_id", "order_date")
    order_rows = order_flags(lookup_join(lookup_join(orders, customers, ["customer_id"], check=True), sequence, ["order_id"]))
    order_rows = order_rows.withColumns(
        {
            "order_month": month_label("order_date"),
            "order_week": iso_week_label("order_date"),
            "day_of_week": weekday_name("order_date"),
            "avg_check": F.col("order_total"),
        }
    )
    hot = hot_from_counts(totals, "order_id", "lines")
    detail = spread_join(priced, order_rows, "order_id", hot=hot).withColumns(
        {
            "margin_pct": ratio("margin", "net_revenue", digits=4, on_zero=0),
            "is_paid": F.coalesce("is_paid", F.lit(0)),
            "is_cancelled": F.coalesce("is_cancelled", F.lit(0)),
        }
    )
    return detail.select(*DETAIL_COLUMNS)


def create_sales_view(
    name: str, items: DataFrame, orders: DataFrame, customers: DataFrame, products: DataFrame
) -> DataFrame:
    """The columns of ``sales_detail`` as a view of the session: SQL over it reads only what it names.

    Every lookup is a left join on a key that the lookup provably holds once, so Spark drops the
    joins whose columns a query does not use: without a customer's column there is no customer
    scan, without totals and numbers no aggregate of the items. Customers, totals and numbers are looked
    up on the order table: the items are shuffled by order once, and never with an order's columns.
    """
    totals = order_totals(items, products)
    numbers = order_sequence(orders, totals).drop("customer_id", "order_date", "order_total", "order_margin")
    numbers = numbers.groupBy("order_id").agg(*[F.first(c).alias(c) for c in numbers.columns if c != "order_id"])
    known = orders.filter("customer_id IS NOT NULL AND order_date IS NOT NULL").select("order_id").distinct()
    totals = totals.drop("lines").join(known, "order_id", "left_semi")
    totals = totals.groupBy("order_id").agg(F.first("order_total").alias("order_total"), F.first("order_margin").alias("order_margin"))
    rows = one_row_a_key(orders, ["order_id"])
    rows = lookup_join(lookup_join(rows, totals, ["order_id"]), numbers, ["order_id"])
    rows = lookup_join(rows, customers, ["customer_id"], check=True)
    # One row an order already: the aggregate lets Spark prove it, and drop this join too.
    rows = rows.groupBy("order_id").agg(*[F.first(c).alias(c) for c in rows.columns if c != "order_id"])
    view = order_flags(lookup_join(price_items(items, products), rows, ["order_id"]))
    view = view.withColumns(
        {
            "order_month": month_label("order_date"),
            "order_week": iso_week_label("order_date"),
            "day_of_week": weekday_name("order_date"),
            "avg_check": F.col("order_total"),
            "margin_pct": ratio("margin", "net_revenue", digits=4, on_zero=0),
        }
    ).select(*DETAIL_COLUMNS)
    view.createOrReplaceTempView(name)
    return view.sparkSession.table(name)


def _paid(detail: DataFrame) -> DataFrame:
    return detail.filter("is_paid = 1")


def _paid_orders(detail: DataFrame) -> DataFrame:
    """Paid rows summed per order: the grain that needs no distinct count of orders."""
    return _paid(detail).groupBy("order_id").agg(
        F.min("order_date").alias("order_date"),
        F.min("customer_id").alias("customer_id"),
        F.min("customer_name").alias("customer_name"),
        F.min("city").alias("city"),
        F.min("customer_type").alias("customer_type"),
        money_sum("net_revenue").alias("revenue"),
        money_sum("gross_revenue", 4).alias("gross_revenue"),
        money_sum("margin").alias("margin"),
        F.sum("quantity").alias("sold_units"),
        F.max("is_repeat_purchase").alias("is_repeat_purchase"),
        F.max("order_total").alias("order_total"),
    )


def daily_metrics(detail: DataFrame) -> DataFrame:
    daily = (
        _paid_orders(detail)
        .filter("order_date IS NOT NULL")
        .groupBy("order_date")
        .agg(
            money_sum("revenue").alias("revenue"),
            money_sum("gross_revenue").alias("gross_revenue"),
            money_sum("margin").alias("margin"),
            long_sum("sold_units").alias("sold_units"),
            F.count(F.lit(1)).alias("orders"),
            F.count_distinct("customer_id").alias("customers"),
            long_sum("is_repeat_purchase").alias("repeat_orders"),
        )
    )
    return (
        daily.withColumn("avg_check", ratio("revenue", "orders", digits=2))
        .withColumn("margin_pct", ratio("margin", "revenue", digits=4))
        .withColumn("repeat_order_share", ratio("repeat_orders", "orders", digits=4, on_zero=0))
        .orderBy("order_date")
    )


def daily_kpi_by_items(items: DataFrame, orders: DataFrame, products: DataFrame, tiebreak: Sequence[str]) -> DataFrame:
    """Daily KPIs where repeat purchases are counted on line items.

    The net amount is rounded in one step here: price times quantity times (1 - discount).
    """
    lines = item_sequence(items, orders, tiebreak, ("customer_id", "order_date", "order_status"))
    lines = order_flags(lookup_join(lines, products.select("product_id", "unit_cost"), ["product_id"], check=True))
    net = F.col("quantity") * F.col("unit_price") * (F.lit(1.0) - F.col("discount_pct"))
    lines = lines.withColumn("net", rounded(net, 2))
    lines = lines.withColumn("margin", rounded(F.col("net") - F.col("quantity") * F.col("unit_cost"), 2))
    paid = F.col("is_paid") == 1
    daily = lines.groupBy("order_date").agg(
        sum_if("net", paid).alias("revenue"),
        F.count_distinct(F.when(paid, F.col("order_id"))).alias("orders"),
        F.count_distinct(F.when(paid, F.col("customer_id"))).alias("customers"),
        sum_if("margin", paid).alias("margin"),
        count_when(paid & (F.col("is_repeat_purchase") == 1)).alias("repeats"),
    )
    return daily.select(
        "order_date",
        "revenue",
        "orders",
        "customers",
        ratio("revenue", "orders", digits=4).alias("avg_check"),
        ratio("margin", "revenue", digits=6).alias("margin_pct"),
        ratio("repeats", "orders", digits=6).alias("repeat_order_share"),
    ).orderBy("order_date")


def category_metrics(detail: DataFrame) -> DataFrame:
    return line_category_metrics(_paid(detail))


def line_category_metrics(paid_lines: DataFrame) -> DataFrame:
    """The same from paid lines alone."""
    keys = ["category", "product_name"]
    grouped = (
        paid_lines.dropna(subset=keys)
        .groupBy(*keys)
        .agg(
            money_sum("net_revenue").alias("revenue"),
            F.count_distinct("order_id").alias("orders"),
            long_sum("quantity").alias("sold_units"),
            money_sum("margin").alias("margin"),
        )
    )
    return (
        grouped.withColumn("avg_check", ratio("revenue", "orders", digits=2))
        .withColumn("margin_pct", ratio("margin", "revenue", digits=4))
        .orderBy(F.col("revenue").desc(), *keys)
    )


def customer_metrics(detail: DataFrame) -> DataFrame:
    keys = ["customer_id", "customer_name", "city", "customer_type"]
    grouped = (
        _paid_orders(detail)
        .dropna(subset=keys)
        .groupBy(*keys)
        .agg(
            F.min("order_date").alias("first_order_date"),
            F.max("order_date").alias("last_order_date"),
            F.count(F.lit(1)).alias("orders"),
            money_sum("order_total").alias("revenue"),
            long_sum("is_repeat_purchase").alias("repeat_purchases"),
        )
    )
    return (
        grouped.withColumn("avg_check", ratio("revenue", "orders", digits=2))
        .withColumn("is_repeat_customer", (F.col("orders") > 1).cast("int"))
        .orderBy(F.col("revenue").desc(), "customer_id")
    )


def overall_kpis(detail: DataFrame) -> DataFrame:
    """One row of headline numbers over all paid orders."""
    total = _paid_orders(detail).agg(
        money_sum("revenue").alias("revenue"),
        F.count(F.lit(1)).alias("orders"),
        money_sum("order_total").alias("order_total"),
        F.count("order_total").alias("order_totals"),
        long_sum("is_repeat_purchase").alias("repeats"),
        money_sum("margin").alias("margin"),
    )
    return total.select(
        "revenue",
        "orders",
        ratio("order_total", "order_totals", digits=2).alias("avg_check"),
        ratio("repeats", "orders", digits=2, times=100.0).alias("repeat_share"),
        ratio("margin", "revenue", digits=2, times=100.0).alias("margin_pct"),
    )


def last_days(daily: DataFrame, days: int = 14) -> DataFrame:
    """The last ``days`` rows of the daily table, oldest first."""
    return daily.orderBy(F.col("order_date").desc()).limit(days).orderBy("order_date")


def top_categories(detail: DataFrame, k: int = 7) -> DataFrame:
    return top_line_categories(_paid(detail), k)


def top_line_categories(paid_lines: DataFrame, k: int = 7) -> DataFrame:
    """The same from paid lines alone."""
    grouped = paid_lines.dropna(subset=["category"]).groupBy("category").agg(money_sum("net_revenue").alias("revenue"))
    return grouped.orderBy(F.col("revenue").desc(), "category").limit(k)


def lookup_violations(lookups: dict[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """Keys that break the many-to-one contract of a lookup, over all lookups."""
    found = [key_violations(dim, on, name) for name, (dim, on) in lookups.items()]
    result = found[0]
    for part in found[1:]:
        result = result.unionByName(part)
    return result


def dictionary_profile(df: DataFrame, dictionary: dict[str, tuple[str, str]]) -> DataFrame:
    """Column descriptions with the number of rows that hold a value, in one pass."""
    columns = list(dictionary)
    counts = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count(c).alias(c) for c in columns])
    rows = [
        F.struct(
            F.lit(c).alias("field"),
            F.lit(dictionary[c][0]).alias("description"),
            F.lit(dictionary[c][1]).alias("type"),
            F.col(c).alias("filled_rows"),
            F.col("_rows").alias("total_rows"),
        )
        for c in columns
    ]
    return counts.select(F.inline(F.array(*rows)))
