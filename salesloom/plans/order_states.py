"""Sales metrics at the order grain: one mergeable row per order, which every metric reads.

The flat item table of ``sales_mart.sales_detail`` is for BI; its metrics need no more than this. Items
are read once, priced and combined before they are shuffled; customers, order numbers and repeat
flags are never joined to items. A customer's first order, found as a minimum, tells what is a
repeat: no order is numbered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesloom.functions.numbers import from_units, money, ratio, rounded
from salesloom.operators.distinct import bits_of, bucket_of, counted_bits, dense_numbers
from salesloom.operators.joins import lookup_join
from salesloom.plans.sales_mart import order_flags, price_items

SUMS = ("lines", "sold_units", "gross", "net", "margin")
_ORDER = ("order_id", "customer_id", "order_date", "order_status")


def _zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0).cast("decimal(28,0)"))


def _units(value: str) -> Column:
    return _zero(F.sum(money(value)))


def order_states(items: DataFrame, products: DataFrame) -> DataFrame:
    """Lines, units and money (whole ten-thousandths, so that states add up exactly) per order.

    Discount, net amount and margin are rounded per line, as in ``price_items``.
    """
    return _summed(price_items(items, products))


def order_states_in_one_step(items: DataFrame, products: DataFrame) -> DataFrame:
    """The same where the net amount is rounded once: price times quantity times (1 - discount)."""
    lines = lookup_join(items, products.select("product_id", "unit_cost"), ["product_id"], check=True)
    net = F.col("quantity") * F.col("unit_price") * (F.lit(1.0) - F.col("discount_pct"))
    lines = lines.withColumn("net_revenue", rounded(net, 2)).withColumn("gross_revenue", F.col("quantity") * F.col("unit_price"))
    return _summed(lines.withColumn("margin", rounded(F.col("net_revenue") - F.col("quantity") * F.col("unit_cost"), 2)))


def _summed(lines: DataFrame) -> DataFrame:
    return lines.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("lines"),
        F.coalesce(F.sum(F.col("quantity").cast("bigint")), F.lit(0)).alias("sold_units"),
        _units("gross_revenue").alias("gross"),
        _units("net_revenue").alias("net"),
        _units("margin").alias("margin"),
    )


def merge_states(states: DataFrame, *more: DataFrame) -> DataFrame:
    """States of several loads as one; an order whose lines came in two loads is one row."""
    for other in more:
        states = states.unionByName(other)
    kinds = {f.name: f.dataType for f in states.schema}
    return states.groupBy("order_id").agg(*[F.sum(c).cast(kinds[c]).alias(c) for c in SUMS])


def sold_orders(states: DataFrame, orders: DataFrame) -> DataFrame:
    """States with customer, date and paid flag of their order; an order that is not known has none."""
    return order_flags(lookup_join(states, orders.select(*_ORDER), ["order_id"])).drop("order_status", "is_cancelled")


def _numbered(rows: DataFrame, dense_ids: bool) -> tuple[DataFrame, str]:
    if dense_ids:
        return rows, "customer_id"
    numbers = dense_numbers(rows.select("customer_id"), "customer_id", "customer_number")
    return rows.join(numbers, "customer_id", "left"), "customer_number"


def _by_day(rows: DataFrame, customer: str, first: Column) -> DataFrame:
    """Sums of paid orders per day, distinct customers, and ``firsts``, the customers whose ``first`` order is that day's and paid.

    Each order is a row of its day and a row of its customer, and both are combined in one aggregate
    before the shuffle; a second one adds up days. ``first`` is a struct that begins with the order's
    place and holds order_date and is_paid; where it is NULL the order is no customer's first.
    """
    paid = F.col("is_paid") == 1
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    day = F.struct(
        F.lit(True).alias("day"),
        F.col("order_date").alias("order_date"),
        F.when(paid, bucket_of(customer)).alias("bucket"),
        F.lit(None).cast(kinds["customer_id"]).alias("customer"),
        F.when(paid, F.col(customer)).cast("bigint").alias("number"),
        F.when(paid, 1).alias("order"),
        F.when(paid & F.col("customer_id").isNotNull(), 1).alias("known"),
        *[F.when(paid, F.col(c)).alias(c) for c in SUMS],
        F.lit(None).cast(rows.select(first).schema[0].dataType).alias("first"),
    )
    own = F.struct(
        F.lit(False).alias("day"),
        F.lit(None).cast(kinds["order_date"]).alias("order_date"),
        F.lit(None).cast("bigint").alias("bucket"),
        F.col("customer_id").alias("customer"),
        F.lit(None).cast("bigint").alias("number"),
        F.lit(None).cast("int").alias("order"),
        F.lit(None).cast("int").alias("known"),
        *[F.lit(None).cast(kinds[c]).alias(c) for c in SUMS],
        first.alias("first"),
    )
    both = rows.select(F.inline(F.array(day, own)))
    combined = both.groupBy("day", "order_date", "bucket", "customer").agg(
        F.count("order").alias("orders"),
        F.count("known").alias("known"),
        *[F.sum(c).alias(c) for c in SUMS],
        bits_of("number").alias("bits"),
        F.min("first").alias("first"),
    )
    combined = combined.filter("day OR first IS NOT NULL")
    date = F.when(F.col("day"), F.col("order_date")).otherwise(F.col("first.order_date"))
    return combined.groupBy(date.alias("order_date")).agg(
        F.sum("orders").alias("orders"),
        F.sum("known").alias("known"),
        *[_zero(F.sum(c)).alias(c) for c in SUMS],
        counted_bits("bits").alias("customers"),
        F.sum(F.when(~F.col("day"), F.col("first.is_paid")).otherwise(0)).alias("firsts"),
    )


def daily_metrics(states: DataFrame, orders: DataFrame, dense_ids: bool = True) -> DataFrame:
    """``sales_mart.daily_metrics`` from order states.

    Distinct customers are counted in bitmaps; ``dense_ids`` says that customer ids are whole numbers
    given out one after another, other ids are numbered first.
    """
    dated = sold_orders(states, orders).filter("order_date IS NOT NULL")
    rows, customer = _numbered(dated, dense_ids)
    first = F.when(F.col("customer_id").isNotNull(), F.struct("order_date", "order_id", "is_paid"))
    daily = _by_day(rows, customer, first).filter("orders > 0").select(
        "order_date",
        from_units("net").alias("revenue"),
        from_units("gross").alias("gross_revenue"),
        from_units("margin").alias("margin"),
        F.col("sold_units").cast("bigint").alias("sold_units"),
        "orders",
        "customers",
        (F.col("known") - F.col("firsts")).alias("repeat_orders"),
    )
    return (
        daily.withColumn("avg_check", ratio("revenue", "orders", digits=2))
        .withColumn("margin_pct", ratio("margin", "revenue", digits=4))
        .withColumn("repeat_order_share", ratio("repeat_orders", "orders", digits=4, on_zero=0))
        .orderBy("order_date")
    )


def daily_kpis(states: DataFrame, orders: DataFrame, dense_ids: bool = True) -> DataFrame:
    """Daily KPIs where repeat purchases are counted on line items, as in ``sales_mart.daily_kpi_by_items``.

    ``states`` are those of ``order_states_in_one_step``. All paid lines of a day are repeats but the
    first line of each customer: the first order, NULL dates before others, has it. Lines without a
    customer are those of one more customer; lines of unknown orders have a day of their own, NULL.
    """
    rows, customer = _numbered(sold_orders(states, orders), dense_ids)
    place = F.struct(F.col("order_date").isNotNull().alias("dated"), "order_date", F.col("order_id").isNotNull().alias("has"), "order_id", "is_paid")
    daily = _by_day(rows, customer, place).select(
        "order_date",
        from_units("net").alias("revenue"),
        "orders",
        "customers",
        from_units("margin").alias("margin"),
        (F.col("lines") - F.col("firsts")).alias("repeats"),
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


def _by_customer(rows: DataFrame) -> DataFrame:
    """Paid orders per customer (one row for those without), and whether its first order is paid."""
    paid = F.col("is_paid") == 1
    numbered = F.col("customer_id").isNotNull() & F.col("order_date").isNotNull()
    first = F.min(F.when(numbered, F.struct("order_date", "order_id", "is_paid")))
    return rows.groupBy("customer_id").agg(
        F.min(F.when(paid, F.col("order_date"))).alias("first_order_date"),
        F.max(F.when(paid, F.col("order_date"))).alias("last_order_date"),
        F.count(F.when(paid, 1)).alias("orders"),
        F.count(F.when(paid & numbered, 1)).alias("numbered"),
        _zero(F.sum(F.when(paid & numbered, F.col("net")))).alias("total"),
        _zero(F.sum(F.when(paid, F.col("net")))).alias("net"),
        _zero(F.sum(F.when(paid, F.col("margin")))).alias("margin"),
        F.coalesce(first["is_paid"], F.lit(0)).alias("first_paid"),
    )


def customer_metrics(states: DataFrame, orders: DataFrame, customers: DataFrame) -> DataFrame:
    """``sales_mart.customer_metrics`` from order states: customers are looked up once per customer (sort by revenue when writing)."""
    keys = ["customer_id", "customer_name", "city", "customer_type"]
    own = _by_customer(sold_orders(states, orders)).filter("orders > 0 AND customer_id IS NOT NULL")
    found = lookup_join(own, customers.select(*keys), ["customer_id"], check=True).dropna(subset=keys)
    return found.select(
        *keys,
        "first_order_date",
        "last_order_date",
        "orders",
        from_units("total").alias("revenue"),
        (F.col("numbered") - F.col("first_paid")).alias("repeat_purchases"),
        ratio(from_units("total"), "orders", digits=2).alias("avg_check"),
        (F.col("orders") > 1).cast("int").alias("is_repeat_customer"),
    )


def overall_kpis(states: DataFrame, orders: DataFrame) -> DataFrame:
    """One row of headline numbers over all paid orders."""
    total = _by_customer(sold_orders(states, orders)).agg(
        *[_zero(F.sum(c)).alias(c) for c in ("net", "margin", "total")],
        *[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in ("orders", "numbered", "first_paid")],
    )
    return total.select(
        from_units("net").alias("revenue"),
        "orders",
        ratio(from_units("total"), "numbered", digits=2).alias("avg_check"),
        ratio(F.col("numbered") - F.col("first_paid"), "orders", digits=2, times=100.0).alias("repeat_share"),
        ratio(from_units("margin"), from_units("net"), digits=2, times=100.0).alias("margin_pct"),
    )


def paid_lines(items: DataFrame, orders: DataFrame, products: DataFrame) -> DataFrame:
    """Priced lines of paid orders, with no column of the order: what category metrics need."""
    paid = order_flags(orders.select("order_id", "order_status")).filter("is_paid = 1").select("order_id")
    return price_items(items, products).join(paid, "order_id", "left_semi")
