"""Clients, attribution, CPA, sales mart, order report on small inputs."""

import hashlib
import pytest
from pyspark.sql import functions as F

from salesloom import schemas
from salesloom.plans import attribution, clients, cpa, orders_report, sales_mart
from tests.conftest import day, moment


def rows(df):
    return sorted(tuple(r) for r in df.collect())


# --- clients -------------------------------------------------------------------------------

def client(row_no, name, phone, email, city="москва", last=None, revenue=0.0, orders=0, loyalty=""):
    return (row_no, f"C{row_no}", None, name, phone, email, city, f"src{row_no}", day("2020-01-01"), last, orders, revenue, loyalty, 1, 0)


@pytest.fixture
def dirty(spark):
    data = [
        client(1, "иван петров", "8 999 111-22-33", None, revenue=10.0),
        client(2, "Иван ПЕТРОВ", "+79991112233", "Ivan@Example.com", last=day("2024-01-01"), revenue=5.0),
        client(3, "анна", "12", "anna@example.com"),
        client(4, "Анна", None, " ANNA@example.com"),
        client(5, "Пётр  Орлов", None, "плохой"),
        client(6, "петр орлов", "", None, city=" МОСКВА "),
        client(7, "Один", None, None, city="тверь"),
    ]
    return clients.with_keys(spark.createDataFrame(data, schemas.DIRTY_CLIENTS))


def test_duplicate_keys(dirty):
    keys = {r["row_no"]: r["duplicate_key"] for r in dirty.collect()}
    assert keys[1] == keys[2] == "phone:+79991112233"
    assert keys[3] == keys[4] == "email:anna@example.com"
    assert keys[5] == keys[6] == "name_city:" + hashlib.sha1("Петр Орлов|Москва".encode()).hexdigest()[:16]


def test_client_master(dirty):
    master = {r["client_id"]: r for r in clients.client_master(dirty).collect()}
    assert set(master) == {"C2", "C3", "C5", "C7"}
    ivan = master["C2"]
    assert (ivan["full_name"], ivan["email"]) == ("Иван Петров", "ivan@example.com")
    assert (ivan["primary_source"], ivan["raw_records_in_group"], ivan["revenue_rub"]) == ("src2", 2, 5.0)
    assert ivan["client_uid"] == hashlib.sha1(b"phone:+79991112233").hexdigest()[:12]


def test_every_raw_record_is_in_one_client(dirty):
    master = clients.client_master(dirty)
    assert master.agg(F.sum("raw_records_in_group")).first()[0] == dirty.count()
    merge = clients.merge_map(dirty)
    assert merge.count() == dirty.count()
    assert merge.select("client_uid").distinct().count() == master.count()


def test_ids_are_listed_in_row_order(dirty):
    listed = {r["client_uid"]: (r["part"], r["merged_client_ids"]) for r in clients.client_id_list(dirty).collect()}
    assert listed[hashlib.sha1(b"phone:+79991112233").hexdigest()[:12]] == (0, "C1, C2")
    assert len(listed) == clients.client_master(dirty).count()


def test_duplicate_groups_are_numbered_in_key_order(dirty):
    groups = {r["duplicate_group_id"]: r["selected_client_id"] for r in clients.duplicate_groups(dirty).collect()}
    keys = sorted({r["duplicate_key"] for r in dirty.collect()})
    expected = {"email:anna@example.com": "C3", "phone:+79991112233": "C2"}
    assert {keys[i - 1]: c for i, c in groups.items() if not keys[i - 1].startswith("name")} == expected
    assert clients.duplicate_records(dirty).count() == 6


def test_client_quality(dirty):
    quality = {r["metric"]: (r["before"], r["after"], r["delta"]) for r in clients.client_quality(dirty).collect()}
    assert quality["Строк в сырой базе"] == (7.0, 4.0, 3.0)
    assert quality["Найдено дублей"] == (3.0, 0.0, 3.0)
    assert quality["Валидных телефонов"] == (2.0, 1.0, -1.0)
    assert quality["Качество контактов, %"] == (35.7, 37.5, 1.8)


def test_one_hot_group_of_copies(spark):
    """A group with most of the rows gives one master, a full merge map and every id in order."""
    data = [client(i, "копия", "9990000000", None, revenue=float(i)) for i in range(1, 2001)] + [client(9999, "Один", None, None)]
    keyed = clients.with_keys(spark.createDataFrame(data, schemas.DIRTY_CLIENTS))
    master = {r["client_id"]: r for r in clients.client_master(keyed).collect()}
    assert master["C2000"]["raw_records_in_group"] == 2000
    parts = sorted((r["part"], r["merged_client_ids"]) for r in clients.client_id_list(keyed).collect() if r["duplicate_key"].startswith("phone"))
    assert [p for p, _ in parts] == list(range(20))
    assert ", ".join(ids for _, ids in parts).split(", ") == [f"C{i}" for i in range(1, 2001)]
    assert clients.merge_map(keyed).count() == 2001


# --- attribution ---------------------------------------------------------------------------

@pytest.fixture
def app(spark):
    m = moment
    installs = [
        (m("2026-06-01T23:30"), "i1", "d1", "Scaleio net", "main", "x", "ios"),
        (m("2026-06-01T23:30"), "i1", "d1", "Scaleio net", "main", "x", "ios"),
        (m("2026-01-01T10:00"), "i2", "d2", "Perfluence", "perfluence_x", "", "android"),
    ]
    purchases = [
        (m("2026-06-02T00:10"), "i1", "d1", "o1"),
        (m("2026-06-02T00:10"), "i1", "d1", "o1"),
        (m("2026-06-02T00:20"), "i1", "d1", "o1"),
        (m("2026-06-02T00:30"), "i1", "d1", "o1"),
        (m("2026-06-03T10:00"), "i2", "d2", "o2"),
        (m("2026-06-03T11:00"), "none", "d9", "o3"),
        (m("2026-06-03T12:00"), "i2", "d2", "web1"),
        (m("2026-06-03T13:00"), "i2", "d2", "app1"),
    ]
    crm = [
        ("o1", "complete", 100.0, 90.0, 0.0, 2, 2, 1, m("2026-06-01T10:00")),
        ("o2", "new", 50.0, None, 0.0, 1, 0, 1, m("2025-07-15T20:00")),
        ("o3", "complete", 70.0, 70.0, 0.0, 1, 1, 0, m("2026-05-31T21:30")),
        ("zz", "complete", 1.0, 1.0, 0.0, 1, 1, 0, m("2026-06-01T10:00")),
    ]
    both = [("web1", "web"), ("app1", "app"), ("app1", "web")]
    links = [("o3", "Perfluence", "deeplink", "source=perfluence")]
    return (
        spark.createDataFrame(installs, schemas.INSTALLS),
        spark.createDataFrame(purchases, schemas.PURCHASES),
        spark.createDataFrame(crm, schemas.CRM_ORDERS),
        spark.createDataFrame(both, schemas.BOTH_ORDERS),
        spark.createDataFrame(links, schemas.WEB_TO_APP),
    )


def test_web_orders_are_removed(app):
    kept = attribution.clean_purchases(app[1], app[3])
    assert sorted({r["ecom_order_id"] for r in kept.collect()}) == ["app1", "o1", "o2", "o3"]
    assert kept.count() == 6


def test_known_orders(app):
    assert sorted(r["increment_id"] for r in attribution.known_orders(app[2], app[1]).collect()) == ["o1", "o2", "o3"]


def test_second_rows_are_dropped_and_first_rows_are_purchases(app):
    data = attribution.attribution(*app)
    o1 = sorted((r["event_time"], r["purchases"]) for r in data.filter("ecom_order_id = 'o1'").collect())
    assert o1 == [(moment("2026-06-02T00:10"), 1), (moment("2026-06-02T00:30"), None)]
    strict = attribution.attribution(*app, strict=True)
    assert strict.filter("ecom_order_id = 'o1'").count() == 1


def test_values_and_deeplink_priority(app):
    data = {r["ecom_order_id"]: r for r in attribution.attribution(*app, strict=True).collect()}
    assert data["o1"]["day_diff"] == 1 and data["o1"]["revenue_ecomm_new"] == 90.0
    assert (data["o2"]["revenue"], data["o2"]["purchases_new"], data["o2"]["gmv_new"]) == (None, None, None)
    o3 = data["o3"]
    assert (o3["partner"], o3["tracker"], o3["flag"], o3["installs"], o3["day_diff"]) == ("Perfluence", "deeplink", "w2a", None, None)
    assert o3["revenue"] == 70.0  # the order of 31 May 21:30 is one of 1 June, three hours later
    assert data["app1"]["partner"] == "Perfluence" and data["app1"]["flag"] is None


def test_month_match_ignores_the_year_unless_told(app):
    crm = app[2].withColumn("created_at_msk", F.col("created_at_msk") - F.expr("INTERVAL '365' DAY"))
    same = attribution.attribution(app[0], app[1], crm, app[3], app[4], strict=True)
    other = attribution.attribution(app[0], app[1], crm, app[3], app[4], strict=True, match="year_month")
    assert same.filter("revenue IS NOT NULL").count() == 2 and other.filter("revenue IS NOT NULL").count() == 0


def test_revenue_is_preserved_in_strict_mode(app):
    joined = attribution.purchase_crm(attribution.clean_purchases(app[1], app[3]), app[2])
    per_order = joined.groupBy("ecom_order_id").agg(F.max("revenue").alias("r"))
    data = attribution.attribution(*app, strict=True)
    assert data.agg(F.sum("revenue")).first()[0] == per_order.agg(F.sum("r")).first()[0]


@pytest.fixture
def reinstalled(app, spark):
    """The app of ``app`` with more installs of an id: an earlier one, one at the same time from elsewhere, a later one."""
    m = moment
    more = [
        (m("2026-05-30T10:00"), "i1", "d1", "Organic", "first", "", "ios"),
        (m("2026-06-01T23:30"), "i1", "d1", "Organic", "main", "x", "ios"),
        (m("2026-06-05T10:00"), "i1", "d7", "Perfluence", "later", "", "android"),
        (m("2026-01-01T10:00"), "i2", "d2", "Perfluence", "perfluence_x", "", "android"),
    ]
    return (app[0].unionByName(spark.createDataFrame(more, schemas.INSTALLS)), *app[1:])


def test_a_purchase_meets_every_install(reinstalled):
    assert attribution.clean_installs(reinstalled[0]).filter("installation_id = 'i1'").count() == 4
    joined = attribution.attributed_purchases(*reinstalled[:4]).filter("ecom_order_id = 'o1'")
    assert joined.count() == 3 * 4
    data = attribution.attribution(*reinstalled).filter("ecom_order_id = 'o1'").collect()
    # Twelve rows, without the second; the earliest install and purchase come first.
    assert len(data) == 11
    bought = [r for r in data if r["purchases"] == 1]
    assert [(r["tracker"], r["event_time"], r["day_diff"]) for r in bought] == [("first", moment("2026-06-02T00:10"), 3)]


def test_revenue_does_not_grow_with_installs(app, reinstalled):
    once = attribution.attribution(*app, strict=True)
    again = attribution.attribution(*reinstalled, strict=True)
    total = lambda df: df.agg(F.sum("revenue"), F.sum("purchases"), F.count("*")).first()
    assert total(once) == total(again)
    assert again.filter("ecom_order_id = 'o1'").first()["tracker"] == "first"


def test_crm_rows_without_a_purchase_do_not_reach_the_distinct(app, spark):
    crm = app[2].unionByName(app[2].withColumn("increment_id", F.concat(F.lit("none"), F.col("increment_id"))))
    found = attribution.attributed_purchases(app[0], app[1], crm, app[3])
    key = [F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in found.columns]
    assert rows(found.select(*key)) == rows(attribution.attributed_purchases(*app[:4]).select(*key))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    # Below the distinct of the CRM columns there is the semi join.
    assert plan.index("Aggregate [ecom_order_id") < plan.index("Join LeftSemi")


def test_period_is_cut_after_numbering(app):
    data = attribution.attribution(*app, as_of="2026-06-03", days=1)
    assert {r["ecom_order_id"] for r in data.collect()} == {"o1"}


def test_a_hot_order_id_gives_the_same_rows(app, spark):
    extra = spark.range(300).select(
        F.expr("timestamp_ntz'2026-06-04 00:00:00' + make_dt_interval(0, 0, cast(id as int), 0)").alias("event_datetime"),
        F.lit("i1").alias("installation_id"),
        F.lit("d1").alias("appmetrica_device_id"),
        F.lit("").alias("ecom_order_id"),
    )
    many = app[1].unionByName(extra)
    plain = attribution.attribution(app[0], many, *app[2:])
    spread = attribution.attribution(app[0], many, *app[2:], rows_per_task=10)
    key = [F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in plain.columns]
    assert rows(plain.select(*key)) == rows(spread.select(*key))
    assert plain.filter("ecom_order_id = ''").count() == 299


# --- CPA -------------------------------------------------------------------------------------

@pytest.mark.parametrize(
    "partner, tracker, parameter, flag, day_diff, source",
    [
        (None, "My_SCALEO", "source=scaleo", None, 3, "scaleo"),
        (None, "x", "source=scaleo", "w2a", None, "scaleo_w2a"),
        ("Perfluence", "x", "", None, 30, None),
        ("Perfluence", "perfluence", "", None, 0, "perfluence"),
        ("Unknown (source: Advertisement Engine)", "x", "scaleo&t=cpa", None, 1, "scaleo_w2a"),
        ("Unknown (source: Advertisement Engine)", "x", "source=admitad", None, 1, "scaleo_w2a"),
        (None, "x", "source=cityads", "w2a", 99, "cityads_w2a"),
        (None, "x", "source=advcake", None, -5, "advcake"),
    ],
)
def test_cpa_sources(spark, partner, tracker, parameter, flag, day_diff, source):
    row = cpa.cpa_segments(attributed(spark, partner, tracker, parameter, flag, day_diff)).first()
    assert row["utm_source"] == source and row["users"] == 1 and row["os"] == "aos"


@pytest.mark.parametrize(
    "partner, parameter, flag, day_diff",
    [(None, "source=scaleo", None, 31), (None, "source=scaleo", None, None), ("Organic", "", None, 1), ("Unknown (source: Advertisement Engine)", "scaleo", None, 1)],
)
def test_cpa_rows_left_out(spark, partner, parameter, flag, day_diff):
    assert cpa.cpa_segments(attributed(spark, partner, "scaleo", parameter, flag, day_diff)).count() == 0


def attributed(spark, partner, tracker, parameter, flag, day_diff):
    numbers = {c: F.lit(1) for c in attribution._CRM_METRICS}
    df = spark.createDataFrame(
        [(moment("2026-06-01T10:00"), "d", partner, tracker, parameter, "android", flag, day_diff)],
        "event_time timestamp_ntz, appmetrica_device_id string, partner string, tracker string, parameter string, os string, flag string, day_diff int",
    )
    return df.withColumns({**numbers, "installs": F.lit(1), "purchases": F.lit(1)})


# --- sales mart ------------------------------------------------------------------------------

@pytest.fixture
def mart(spark):
    items = spark.createDataFrame(
        [
            ("o1", "p1", 2, 10.0, 0.1),
            ("o1", "p2", 1, 5.05, 0.1),
            ("o2", "p1", 1, 10.0, 0.0),
            ("o3", "p9", 1, 7.0, 0.0),
            ("lost", "p1", 1, 3.0, 0.0),
            ("o4", "p1", 1, 0.0, 0.0),
        ],
        schemas.MART_ITEMS,
    )
    orders = spark.createDataFrame(
        [
            ("o1", "c1", day("2026-06-25"), "web", "card", "paid", "m"),
            ("o2", "c1", day("2026-06-25"), "web", "card", "refunded", "m"),
            ("o3", "c2", day("2026-06-24"), "app", "card", "cancelled", "m"),
            ("o4", None, day("2026-06-24"), "app", "card", "paid", "m"),
            ("empty", "c1", day("2026-01-01"), "app", "card", "paid", "m"),
        ],
        schemas.MART_ORDERS,
    )
    customers = spark.createDataFrame([("c1", "One", "X", "B2B", None, None), ("c2", "Two", "Y", "B2C", None, None)], schemas.MART_CUSTOMERS)
    products = spark.createDataFrame([("p1", "A", "cat", 10.0, 4.0), ("p2", "B", "cat", 5.0, 9.0)], schemas.MART_PRODUCTS)
    return items, orders, customers, products


def test_sales_detail(mart):
    detail = {(r["order_id"], r["product_id"]): r for r in sales_mart.sales_detail(*mart).collect()}
    assert len(detail) == 6
    first = detail[("o1", "p1")]
    assert (first["net_revenue"], first["margin"], first["order_total"], first["order_sequence"]) == (18, 10, 22.55, 1)
    second = detail[("o1", "p2")]
    assert (second["discount_amount"], second["net_revenue"]) == (0.5, 4.55)
    assert detail[("o2", "p1")]["order_sequence"] == 2 and detail[("o2", "p1")]["is_repeat_purchase"] == 1
    lost = detail[("lost", "p1")]
    assert (lost["customer_id"], lost["is_paid"], lost["order_total"]) == (None, 0, None)
    assert detail[("o4", "p1")]["margin_pct"] == 0.0 and detail[("o4", "p1")]["order_sequence"] is None
    assert detail[("o3", "p9")]["product_name"] is None


def test_order_totals_add_up(mart):
    detail = sales_mart.sales_detail(*mart).filter("order_total IS NOT NULL")
    items = detail.agg(F.sum("net_revenue")).first()[0]
    orders = detail.select("order_id", "order_total").distinct().agg(F.sum("order_total")).first()[0]
    assert items == orders


def test_mart_metrics(mart):
    detail = sales_mart.sales_detail(*mart)
    daily = {r["order_date"]: r for r in sales_mart.daily_metrics(detail).collect()}
    june25 = daily[day("2026-06-25")]
    assert (june25["revenue"], june25["orders"], june25["customers"], june25["repeat_orders"], june25["avg_check"]) == (32.55, 2, 1, 1, 16.27)
    assert daily[day("2026-06-24")]["margin_pct"] is None
    customer = sales_mart.customer_metrics(detail).collect()
    assert [(r["customer_id"], r["orders"], r["is_repeat_customer"]) for r in customer] == [("c1", 2, 1)]
    category = {r["product_name"]: r["orders"] for r in sales_mart.category_metrics(detail).collect()}
    assert category == {"A": 3, "B": 1}
    kpis = sales_mart.overall_kpis(detail).first()
    assert (kpis["revenue"], kpis["orders"], kpis["avg_check"]) == (32.55, 3, 16.27)
    assert [r["order_date"] for r in sales_mart.last_days(sales_mart.daily_metrics(detail), 1).collect()] == [day("2026-06-25")]
    assert sales_mart.top_categories(detail).count() == 1


def test_items_and_orders_are_numbered_differently(mart):
    lines = {(r["order_id"], r["product_id"]): r["order_sequence"] for r in sales_mart.item_sequence(mart[0], mart[1], ["product_id"]).collect()}
    assert (lines[("o1", "p1")], lines[("o1", "p2")], lines[("o2", "p1")]) == (1, 2, 3)


def test_violations_are_reported(mart):
    dims = {"orders": (mart[1].union(mart[1].limit(1)), ["order_id"]), "products": (mart[3], ["product_id"])}
    found = sales_mart.lookup_violations(dims).collect()
    assert [(r["lookup"], r["copies"]) for r in found] == [("orders", 2)]


def test_dictionary(mart):
    from salesloom.fixed_values import SALES_DICTIONARY

    rows_ = {r["field"]: (r["filled_rows"], r["total_rows"]) for r in sales_mart.dictionary_profile(sales_mart.sales_detail(*mart), SALES_DICTIONARY).collect()}
    assert rows_["customer_id"] == (4, 6) and len(rows_) == len(SALES_DICTIONARY)


# --- order report ------------------------------------------------------------------------------

def test_order_reports(spark):
    m = moment
    orders = spark.createDataFrame(
        [
            (1, 10, m("2026-06-01T00:00"), "paid", "web", "X", 7),
            (2, 10, m("2026-06-01T12:00"), "Shipped", "web", "X", 7),
            (3, 11, m("2026-06-30T23:59:59"), "paid", "web", "X", 99),
            (4, 11, m("2026-07-01T00:00"), "paid", "web", "X", 7),
            (5, 11, m("2026-06-01T09:00"), "paid", "web", "X", 7),
        ],
        schemas.REPORT_ORDERS,
    )
    items = spark.createDataFrame([(1, 1, 2, 10.0, 1.0), (1, 2, 1, 5.0, 0.0), (2, 1, 1, 10.0, 0.0), (3, 3, 1, 4.0, 0.0), (4, 1, 1, 1.0, 0.0)], schemas.REPORT_ITEMS)
    products = spark.createDataFrame([(1, "a", "n"), (2, "demo", "n")], schemas.REPORT_PRODUCTS)
    managers = spark.createDataFrame([(7, "M", "dep")], schemas.MANAGERS)
    dates = ("2026-06-01", "2026-07-01")
    lean = {(r["order_date"], r["department"]): r for r in orders_report.orders_report(orders, items, managers, *dates).collect()}
    assert set(lean) == {(day("2026-06-01"), "dep"), (day("2026-06-30"), None)}
    assert (lean[(day("2026-06-01"), "dep")]["orders"], lean[(day("2026-06-01"), "dep")]["revenue"]) == (1, 24.0)
    heavy = orders_report.orders_report_heavy(orders, items, products, managers, *dates).collect()
    assert [(r["orders"], r["revenue"], r["avg_item_revenue"], r["customers"], r["paid_orders_same_day"]) for r in heavy] == [(2, 29.0, 14.5, 1, 2)]
    filtered = orders_report.orders_report(orders, items, managers, *dates, products=products, exclude_categories=("demo",)).collect()
    assert [(r["orders"], r["revenue"]) for r in filtered] == [(1, 19.0)]


def test_period_filter_reaches_the_scan(spark, tmp_path):
    orders = spark.createDataFrame([(1, 10, moment("2026-06-01T00:00"), "paid", "web", "X", 7)], schemas.REPORT_ORDERS)
    orders.write.parquet(str(tmp_path / "o"))
    items = spark.createDataFrame([(1, 1, 2, 10.0, 1.0)], schemas.REPORT_ITEMS)
    managers = spark.createDataFrame([(7, "M", "dep")], schemas.MANAGERS)
    report = orders_report.orders_report(spark.read.parquet(str(tmp_path / "o")), items, managers, "2026-06-01", "2026-07-01")
    plan = report._jdf.queryExecution().executedPlan().toString()
    pushed = next(line for line in plan.splitlines() if "PushedFilters" in line)
    assert "GreaterThanOrEqual(created_at" in pushed and "In(status" in pushed
