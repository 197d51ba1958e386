"""CSV folders, monthly refresh, bucketed tables and the sales view."""

import random

import pytest
from pyspark.sql import functions as F

from salesloom import schemas
from salesloom.plans import sales_mart
from salesloom.sources import files, sinks
from tests.conftest import day
from tests.test_order_states import final_plan, tables  # noqa: F401


def test_csv_folder_with_different_headers(spark, tmp_path):
    folder = tmp_path / "leads in"
    folder.mkdir()
    names = [f.name for f in schemas.BOT_LEADS]
    (folder / "a.csv").write_text(",".join(names) + "\n" + ",".join(f"a-{n}" for n in names) + "\n")
    turned = names[::-1]
    (folder / "b 1.csv").write_text(",".join(turned) + "\r\n" + ",".join(f"b-{n}" for n in turned) + "\r\n")
    (folder / "c.csv").write_text("extra,lead_id,more,phone\n1,c-lead_id,2,c-phone\n")
    (folder / "d.csv").write_text(",".join(names) + "\n" + ",".join(f"d-{n}" for n in names) + "\n")
    (folder / "empty.csv").write_text("")
    (folder / "only_header.csv").write_text("lead_id,phone\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    found = files.read_csv(spark, str(folder), schemas.BOT_LEADS)
    rows = {r["lead_id"]: r for r in found.collect()}
    assert set(rows) == {"a-lead_id", "b-lead_id", "c-lead_id", "d-lead_id"}
    texts = [f.name for f in schemas.BOT_LEADS if f.dataType.simpleString() == "string"]
    for file in "abd":
        assert [rows[f"{file}-lead_id"][n] for n in texts] == [f"{file}-{n}" for n in texts]
    assert rows["c-lead_id"]["phone"] == "c-phone" and rows["c-lead_id"]["email"] is None
    # a.csv and d.csv are one scan.
    assert len(files._by_header(spark, str(folder))) == 4
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before


def test_csv_folder_without_lines(spark, tmp_path):
    (tmp_path / "x.csv").write_text("")
    assert files.read_csv(spark, str(tmp_path), schemas.BOT_LEADS).count() == 0


def daily_sums(rows):
    return rows.groupBy("date", "k").agg(F.sum("v").alias("v"), F.count("*").alias("n"))


@pytest.mark.parametrize("kind", ["date", "timestamp_ntz"])
def test_refresh_rewrites_the_touched_month_only(spark, tmp_path, kind):
    rng = random.Random(1)
    data = [(day(f"2026-{rng.randint(4, 7):02}-{rng.randint(1, 28):02}"), f"k{rng.randint(0, 5)}", rng.randint(0, 99)) for _ in range(600)]
    old = spark.createDataFrame(data, "date date, k string, v int").withColumn("date", F.col("date").cast(kind))
    new = spark.createDataFrame([(day("2026-06-30"), "k1", 7), (day("2026-06-30"), "late", 8), (None, "x", 1)], "date date, k string, v int")
    new = new.withColumn("date", F.col("date").cast(kind))
    path, whole = str(tmp_path / "mart"), str(tmp_path / "whole")
    assert sinks.refresh_monthly(old, old, daily_sums, path, "date", "date", ["date", "k"]) == ["2026-04", "2026-05", "2026-06", "2026-07"]
    stamps = {p: p.stat().st_mtime_ns for p in (tmp_path / "mart").rglob("*.parquet")}
    both = old.unionByName(new)
    assert sinks.refresh_monthly(both, new, daily_sums, path, "date", "date", ["date", "k"]) == ["2026-06"]
    after = {p: p.stat().st_mtime_ns for p in (tmp_path / "mart").rglob("*.parquet")}
    other = {p for p in stamps if "month=2026-06" not in str(p)}
    assert other and all(after.get(p) == stamps[p] for p in other)
    assert not {p for p in stamps if "month=2026-06" in str(p)} & set(after)
    sinks.write_monthly(daily_sums(both.filter("date IS NOT NULL")), whole, "date", ["date", "k"])
    read = lambda p: sorted(map(str, spark.read.parquet(p).collect()))
    assert read(path) == read(whole)
    assert sinks.refresh_monthly(both, new.limit(0), daily_sums, path, "date", "date", ["k"]) == []


def test_a_refresh_reads_the_touched_month_only(spark, tmp_path):
    rows = spark.range(200).select(F.date_add(F.lit("2026-01-01").cast("date"), F.col("id").cast("int")).alias("date"), "id")
    rows.write.parquet(str(tmp_path / "source"))
    part = sinks.in_months(spark.read.parquet(str(tmp_path / "source")), "date", ["2026-03", "2026-05"])
    assert part.count() == 62
    assert "GreaterThanOrEqual(date,2026-03-01)" in part._jdf.queryExecution().executedPlan().toString()


def test_bucketed_tables_join_without_an_exchange(spark, tmp_path):
    orders = spark.range(500).select(F.col("id").alias("order_id"), (F.col("id") % 7).alias("customer"))
    items = spark.range(3000).select((F.col("id") % 600).alias("order_id"), F.col("id").alias("line"))
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, "-1")
        sinks.write_bucketed(orders, "bucketed_orders", str(tmp_path / "orders"), "order_id", 8)
        sinks.write_bucketed(items, "bucketed_items", str(tmp_path / "items"), "order_id", 8, ["line"])
        joined = spark.table("bucketed_items").join(spark.table("bucketed_orders"), "order_id", "left").groupBy("order_id").agg(F.count("*").alias("n"), F.first("customer").alias("c"))
        plan = final_plan(joined)
        assert "Exchange" not in plan and "SortMergeJoin" in plan
        plain = items.join(orders, "order_id", "left").groupBy("order_id").agg(F.count("*").alias("n"), F.first("customer").alias("c"))
        assert sorted(joined.collect()) == sorted(plain.collect())
        assert len(list((tmp_path / "items").glob("*.parquet"))) == 8
    finally:
        spark.conf.set(key, before)
        for name in ("bucketed_orders", "bucketed_items"):
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_sales_view(spark, tables, tmp_path):  # noqa: F811
    names = ("items", "orders", "customers", "products")
    stored = []
    for name, df in zip(names, tables):
        df.write.parquet(str(tmp_path / name))
        stored.append(spark.read.parquet(str(tmp_path / name)))
    view = sales_mart.create_sales_view("sales_view_of_test", *stored)
    columns = [F.col(c).cast("string").alias(c) for c in view.columns]
    want = sales_mart.sales_detail(*tables).withColumns({c: F.col(c).cast("string") for c in view.columns})
    assert sorted(map(str, view.select(*columns).collect())) == sorted(map(str, want.collect()))

    def reads(sql):
        plan = spark.sql(sql)._jdf.queryExecution().optimizedPlan().toString()
        physical = spark.sql(sql)._jdf.queryExecution().executedPlan().toString()
        return {n for n in names if f"/{n}]" in physical}, plan

    assert reads("SELECT net_revenue FROM sales_view_of_test")[0] == {"items"}
    assert reads("SELECT category, net_revenue FROM sales_view_of_test")[0] == {"items", "products"}
    used, plan = reads("SELECT order_month, sum(net_revenue) FROM sales_view_of_test GROUP BY 1")
    assert used == {"items", "orders"} and "Window" not in plan
    used, plan = reads("SELECT customer_name FROM sales_view_of_test")
    assert "customers" in used and "Window" not in plan
    # Customers are looked up on the orders: no item is shuffled by customer.
    lines = plan.splitlines()
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    at = next(i for i, line in enumerate(lines) if "Join LeftOuter, (customer_id" in line)
    below = lines[at + 1 : next((i for i in range(at + 1, len(lines)) if depth(lines[i]) <= depth(lines[at])), len(lines))]
    assert any("order_status" in line for line in below) and not any("quantity" in line for line in below)
    assert "Window" in reads("SELECT order_sequence FROM sales_view_of_test")[1]
    spark.catalog.dropTempView("sales_view_of_test")
