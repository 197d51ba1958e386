"""Metrics from order states: equal to those of the item table, one scan of the items, no Expand."""

import os
import random

import pytest
from pyspark.sql import functions as F

from salesloom.operators import distinct
from salesloom.plans import order_states, sales_mart
from salesloom.registry import queries
from tests.conftest import day

FOLDER = os.environ.get("SAMPLE_DIR", "/root/testdata/sf0.001")
ORDERS = (
    "order_id string, customer_id long, order_date date, sales_channel string, payment_method string, order_status string, manager string"
)


@pytest.fixture(scope="module")
def tables(spark):
    """Orders without customer, date, status or lines; lines without product or order; customers without a name."""
    rng = random.Random(3)
    statuses = ["paid", "paid", "refunded", "cancelled", "new", None]
    orders = [
        (f"o{k}", rng.choice([*range(1, 9), None]), rng.choice([day(f"2026-06-{d:02d}") for d in range(1, 7)] + [None]), "site", "card", rng.choice(statuses), "m")
        for k in range(90)
    ]
    items = [
        (rng.choice([f"o{k}" for k in range(95)] + [None]), rng.choice([*range(5), 77]), k, rng.randint(1, 4), rng.choice([9.99, 100.0, 0.335]), rng.choice([0.0, 0.1, 0.15]))
        for k in range(260)
    ]
    customers = [(k, None if k == 3 else f"n{k}", "c", "B2B") for k in range(1, 8)]
    products = [(k, None if k == 4 else f"p{k}", "cat" if k % 2 else "dog", 3.21 * k) for k in range(5)]
    return (
        spark.createDataFrame(items, "order_id string, product_id long, line_no int, quantity int, unit_price double, discount_pct double"),
        spark.createDataFrame(orders, ORDERS),
        spark.createDataFrame(customers, "customer_id long, customer_name string, city string, customer_type string"),
        spark.createDataFrame(products, "product_id long, product_name string, category string, unit_cost double"),
    )


def rows(df):
    columns = sorted(df.columns)
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


def test_metrics_equal_those_of_the_item_table(tables):
    items, orders, customers, products = tables
    detail = sales_mart.sales_detail(*tables)
    states = order_states.order_states(items, products)
    assert rows(order_states.daily_metrics(states, orders)) == rows(sales_mart.daily_metrics(detail))
    assert rows(order_states.customer_metrics(states, orders, customers)) == rows(sales_mart.customer_metrics(detail))
    assert rows(order_states.overall_kpis(states, orders)) == rows(sales_mart.overall_kpis(detail))
    lines = order_states.paid_lines(items, orders, products)
    assert rows(sales_mart.line_category_metrics(lines)) == rows(sales_mart.category_metrics(detail))
    assert rows(sales_mart.top_line_categories(lines)) == rows(sales_mart.top_categories(detail))
    stepped = order_states.order_states_in_one_step(items, products)
    assert rows(order_states.daily_kpis(stepped, orders)) == rows(sales_mart.daily_kpi_by_items(items, orders, products, ["line_no"]))


def test_states_of_two_loads_add_up(tables):
    items, orders, _, products = tables
    whole = order_states.order_states(items, products)
    loads = [order_states.order_states(items.filter(F.col("line_no") % 2 == k), products) for k in (0, 1)]
    assert rows(order_states.merge_states(*loads)) == rows(whole)
    assert order_states.merge_states(*loads).schema["net"].dataType == whole.schema["net"].dataType
    assert rows(order_states.daily_metrics(order_states.merge_states(*loads), orders)) == rows(order_states.daily_metrics(whole, orders))


def test_customer_ids_that_are_texts(tables):
    items, orders, _, products = tables
    states = order_states.order_states(items, products)
    named = orders.withColumn("customer_id", F.concat(F.lit("customer "), "customer_id"))
    for metric in (order_states.daily_metrics, order_states.daily_kpis):
        assert rows(metric(states, named, dense_ids=False)) == rows(metric(states, orders))


def test_bitmaps_count_exactly_and_merge(spark):
    numbers = spark.range(200_000).select((F.col("id") % 70_001 - 100).alias("n"), (F.col("id") % 3).alias("g"), (F.col("id") % 2).alias("load"))
    numbers = numbers.unionByName(spark.createDataFrame([(None, 0, 0), (None, 7, 1)], "n long, g long, load long"))
    bucket = distinct.bucket_of("n").alias("bucket")
    states = numbers.groupBy("g", "load", bucket).agg(distinct.bits_of("n").alias("bits"))
    merged = states.groupBy("g", "bucket").agg(distinct.merged_bits("bits").alias("bits"))
    found = {r["g"]: r["n"] for r in merged.groupBy("g").agg(distinct.counted_bits("bits").alias("n")).collect()}
    want = {r["g"]: r["n"] for r in numbers.groupBy("g").agg(F.count_distinct("n").alias("n")).collect()}
    assert found == want and want[7] == 0


def test_a_bitmap_takes_no_more_room_than_a_number(spark):
    # Customers of a day that are far apart have a bitmap each: 4 KiB for every one of them is too much.
    far = spark.range(3000).select((F.col("id") * 100_003).alias("n"))
    states = far.groupBy(distinct.bucket_of("n").alias("bucket")).agg(distinct.bits_of("n").alias("bits"))
    assert states.schema["bits"].dataType.simpleString() == "bigint"
    assert states.agg(distinct.counted_bits("bits").alias("n")).first()["n"] == 3000


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="sample tables not found")
@pytest.mark.parametrize(
    "key",
    ["sales_daily_metrics", "sales_last_14_days", "sales_daily_kpi_sql", "customer_metrics", "sales_overall_kpis", "category_metrics", "top_categories", "orders_report_heavy"],
)
def test_items_are_read_once_and_not_expanded(spark, key):
    plan = final_plan(queries()[key](spark, FOLDER))
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert sum("lineitem.parquet" in s for s in scans) == 1
    assert "Expand" not in plan
    if key in ("category_metrics", "top_categories"):
        assert not any("customer.parquet" in s for s in scans) and "Window" not in plan
