"""Small hand-computed inputs for the report marts."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from salesloom import schemas
from salesloom.plans import ad_sales, ads_report, charts, crm, sales_report, stock
from tests.conftest import day, moment


def by(df, *keys):
    return {tuple(r[k] for k in keys) if len(keys) > 1 else r[keys[0]]: r for r in df.collect()}


# --- ad spend, leads, orders ---------------------------------------------------------

@pytest.fixture
def ad_inputs(spark):
    spend = spark.createDataFrame(
        [
            (day("2026-01-01"), "north", "one", 1000, 50, 500.0),
            (day("2026-01-01"), "north", "one", 1000, 50, 500.0),
            (day("2026-01-01"), "south", "two", 0, 0, 80.0),
        ],
        schemas.AD_SPEND,
    )
    leads = spark.createDataFrame(
        [
            ("l1", moment("2026-01-01T10:00"), "north", "one", "won", "o1"),
            ("l1", moment("2026-01-01T11:00"), "north", "one", "new", ""),
            ("l2", moment("2026-01-01T12:00"), "north", "one", "new", None),
            ("l3", moment("2026-01-02T12:00"), "west", "three", "won", "missing"),
        ],
        schemas.CRM_LEADS,
    )
    orders = spark.createDataFrame([("o1", moment("2026-01-01T15:00"), 3000.0, 0.5)], schemas.PAID_ORDERS)
    return spend, leads, orders


def test_ad_sales_report(ad_inputs):
    report = by(ad_sales.ad_sales_report(*ad_inputs), "channel")
    north = report["north"]
    assert (north["cost"], north["leads"], north["sales"], north["revenue"]) == (1000.0, 2, 1, 3000.0)
    assert (north["ctr"], north["cpl"], north["cpo"], north["cr_lead_to_sale"], north["romi"]) == (0.05, 500.0, 1000.0, 0.5, 0.5)
    assert (report["south"]["leads"], report["south"]["cpl"], report["south"]["ctr"], report["south"]["romi"]) == (0, 0.0, 0.0, -1.0)
    assert (report["west"]["cost"], report["west"]["sales"], report["west"]["revenue"], report["west"]["romi"]) == (0.0, 1, 0.0, 0.0)


def test_ad_sales_cost_is_preserved(ad_inputs):
    report = ad_sales.ad_sales_report(*ad_inputs)
    summary = ad_sales.channel_summary(report)
    spent = ad_inputs[0].agg(F.sum("cost")).first()[0]
    assert report.agg(F.sum("cost")).first()[0] == summary.agg(F.sum("cost")).first()[0] == spent
    assert [r["channel"] for r in summary.collect()] == ["north", "south", "west"]
    line = by(ad_sales.channel_messages(summary), "channel")["north"]["message"]
    assert line == "• north: 1 000 ₽  лиды 2  продажи 1  ROMI 50.0%"


def test_one_lead_cpl(spark):
    spend = spark.createDataFrame([(day("2026-06-25"), "c", "k", 100, 10, 1000.0)], schemas.AD_SPEND)
    leads = spark.createDataFrame([("1", moment("2026-06-25T10:00"), "c", "k", "won", "7")], schemas.CRM_LEADS)
    orders = spark.createDataFrame([("7", moment("2026-06-25T12:00"), 5000.0, 0.3)], schemas.PAID_ORDERS)
    row = ad_sales.ad_sales_report(spend, leads, orders).first()
    assert (row["leads"], row["sales"], row["cpl"]) == (1, 1, 1000.0)


# --- ads report -------------------------------------------------------------------------

@pytest.fixture
def ads(spark):
    rows = [
        (day("2026-03-02"), "s1", "good", 1000, 100, 10000.0, 20, 5, 60000.0),
        (day("2026-03-02"), "s1", "no orders", 500, 10, 12000.0, 2, 0, 0.0),
        (day("2026-03-02"), "s2", "dear", 500, 10, 4000.0, 2, 1, 20000.0),
        (day("2026-03-02"), "s2", "cheap", 500, 10, 100.0, 2, 0, 0.0),
        (day("2026-03-01"), "s1", "good", 1000, 100, 10000.0, 40, 10, 90000.0),
    ]
    return spark.createDataFrame(rows, schemas.ADS_DAILY)


def test_ads_kpis(ads):
    kpis = by(ads_report.daily_kpis(ads, "2026-03-02"), "kpi")
    assert (kpis["spend"]["value"], kpis["spend"]["prev_value"], kpis["spend"]["delta_pct"]) == (26100.0, 10000.0, 161.0)
    assert (kpis["leads"]["value"], kpis["leads"]["delta_pct"], kpis["leads"]["is_good"]) == (26.0, -35.0, False)
    assert kpis["spend"]["is_good"] is False
    labels = by(ads_report.kpi_labels(ads, "2026-03-02"), "title")
    assert labels["Расход"]["message_line"] == "Расход: 26 100 ₽ (+161.0% к прошлому дню)"
    assert labels["ROAS"]["label"] == "3.07x"


def test_bad_campaigns_and_alerts(ads):
    bad = [r["campaign"] for r in ads_report.bad_campaigns(ads, "2026-03-02").collect()]
    assert bad == ["no orders", "dear"]
    alerts = by(ads_report.ad_alerts(ads, "2026-03-02"), "code")
    assert set(alerts) == {"leads_down", "cpl_up", "cpa_up", "roas_down", "bad_campaigns"}
    assert alerts["bad_campaigns"]["message"].endswith(": 2")


def test_ads_first_day_has_no_previous(ads):
    kpis = by(ads_report.daily_kpis(ads, "2026-03-01"), "kpi")
    assert {k["delta_pct"] for k in kpis.values()} == {100.0}


def test_ads_empty_day(ads):
    kpis = by(ads_report.daily_kpis(ads, "2025-01-01"), "kpi")
    assert {(k["value"], k["delta_pct"], k["is_good"]) for k in kpis.values()} == {(0.0, 0.0, True)}
    assert [r["code"] for r in ads_report.ad_alerts(ads, "2025-01-01").collect()] == ["roas_low"]


def test_ads_breakdowns(ads):
    assert [r["source"] for r in ads_report.by_source(ads, "2026-03-02").collect()] == ["s1", "s2"]
    assert [r["campaign"] for r in ads_report.top_campaigns(ads, "2026-03-02", k=2).collect()] == ["no orders", "good"]


# --- sales report ------------------------------------------------------------------------

@pytest.fixture
def sales(spark):
    d, p = day("2026-03-02"), day("2026-03-01")
    rows = [
        (d, "1", "c1", 100.0, " Paid", "web", "x", True),
        (d, "1", "c1", 50.0, "paid", "web", "x", True),
        (d, "2", "c2", 30.0, "DONE", "app", None, False),
        (d, "3", "c3", 10.0, "cancelled", "web", "x", False),
        (d, "4", "c4", 10.0, "cancel", "web", "x", False),
        (d, "5", "c5", 10.0, "canceled", "web", "y", False),
        (p, "6", "c6", 400.0, "success", "web", "x", False),
        (p, "7", "c7", 10.0, "cancelled", "web", "x", False),
    ]
    return spark.createDataFrame(rows, schemas.SALES_ORDERS)


def test_sales_kpis(sales):
    kpis = by(sales_report.daily_kpis(sales, "2026-03-02"), "kpi")
    assert [kpis[k]["value"] for k in ("revenue", "orders", "avg_check", "new_clients", "cancels")] == [180.0, 2.0, 90.0, 2.0, 3.0]
    assert kpis["orders"]["delta_pct"] == 100.0 and kpis["revenue"]["delta_label"] == "-55.0%"


def test_sales_breakdowns_and_alerts(sales):
    assert [(r["channel"], r["orders"]) for r in sales_report.by_channel(sales, "2026-03-02").collect()] == [("web", 1), ("app", 1)]
    assert [r["category"] for r in sales_report.by_category(sales, "2026-03-02").collect()] == ["x"]
    codes = {r["code"] for r in sales_report.sales_alerts(sales, "2026-03-02").collect()}
    assert codes == {"revenue_down", "avg_check_down", "cancels_up"}
    assert [r["code"] for r in sales_report.sales_alerts(sales, "2026-03-05").collect()] == ["none"]


def test_channel_day_counts_distinct_new_customers(sales):
    rows = by(sales_report.channel_day(sales, "2026-03-02"), "order_date", "channel", "category")
    web = rows[(day("2026-03-02"), "web", "x")]
    assert (web["orders"], web["new_clients"], web["canceled_orders"], web["avg_check"]) == (1, 1, 2, 150.0)
    assert rows[(day("2026-03-02"), "web", "y")]["avg_check"] is None


# --- stock ----------------------------------------------------------------------------------

def stock_of(spark, stock_units, reserved, sold, price=100.0, cost=50.0, rate=0.1):
    s = spark.createDataFrame([("m", "a", "w", stock_units, reserved, price, rate, "active")], schemas.STOCK)
    o = spark.createDataFrame([(day("2026-06-24"), "m", "a", sold, 10.0 * sold)], schemas.STOCK_ORDERS)
    p = spark.createDataFrame([("a", "Thing", "cat", cost)], schemas.STOCK_PRODUCTS)
    return stock.stock_report(s, o, p, "2026-06-23", "2026-06-25").first()


@pytest.mark.parametrize(
    "units, reserved, sold, cost, alert, days_left",
    [
        (2, 2, 3, 50.0, "out_of_stock", 0.0),
        (2, 0, 3, 50.0, "reorder", 2.0),
        (20, 0, 20, 50.0, "reorder", 3.0),
        (100, 0, 1, 80.0, "low_margin", 303.0),
        (100, 0, 0, 50.0, "ok", 999.0),
        (1, 5, 0, 50.0, "out_of_stock", 999.0),
    ],
)
def test_stock_alerts(spark, units, reserved, sold, cost, alert, days_left):
    row = stock_of(spark, units, reserved, sold, cost=cost)
    assert (row["alert"], row["days_of_stock"]) == (alert, days_left)


def test_stock_orders_outside_the_period_do_not_count(spark):
    s = spark.createDataFrame([("m", "a", "w", 50, 0, 100.0, 0.1, "active")], schemas.STOCK)
    o = spark.createDataFrame(
        [(day("2026-06-22"), "m", "a", 7, 70.0), (day("2026-06-23"), "m", "a", 1, 10.0), (day("2026-06-26"), "m", "a", 7, 70.0)],
        schemas.STOCK_ORDERS,
    )
    p = spark.createDataFrame([], schemas.STOCK_PRODUCTS)
    row = stock.stock_report(s, o, p, "2026-06-23", "2026-06-25", loaded_at="2026-06-26 08:00:00").first()
    assert (row["orders_3d"], row["revenue_3d"], row["product_name"], row["gross_margin_rate"]) == (1, 10.0, None, None)
    assert row["loaded_at"] == moment("2026-06-26T08:00")


# --- CRM ------------------------------------------------------------------------------------

@pytest.fixture
def requests(spark):
    m = moment
    rows = [
        (1, m("2026-06-20T10:00"), m("2026-06-20T10:00"), m("2026-06-24T10:00"), m("2026-06-30T10:00"), "В работе", "Высокий", "s", " Анна ", "c1", 200000.0),
        (2, m("2026-06-25T10:00"), m("2026-06-25T10:00"), m("2026-06-25T23:59:59"), None, "Новая", "Средний", "s", None, "c2", 100.0),
        (3, m("2026-06-25T11:00"), m("2026-06-25T11:00"), m("2026-06-26T00:00"), m("2026-06-25T12:00"), "Новая", "Средний", "s", "Олег", "c3", None),
        (4, m("2026-06-01T10:00"), m("2026-06-01T10:00"), m("2026-06-02T10:00"), m("2026-06-03T10:00"), "Закрыта", "Критичный", "s", "", "c4", 999999.0),
        (5, m("2026-06-27T10:00"), m("2026-06-27T10:00"), None, None, None, None, "s", "Олег", "c5", 5.0),
    ]
    return spark.createDataFrame(rows, schemas.CRM_REQUESTS)


def test_crm_flags_and_metrics(requests):
    flags = crm.crm_flags(requests, "2026-06-25")
    metrics = {r["metric"]: r["value"] for r in crm.crm_metrics(flags).collect()}
    assert metrics == {
        "total_open": 4, "new_today": 2, "overdue_action": 2, "overdue_close": 1, "without_manager": 1, "stale": 1,
        "hot_overdue": 1, "problem_cases": 3, "risk_amount": 200100,
    }
    scores = {r["request_id"]: (r["risk_score"], r["days_without_update"]) for r in flags.collect()}
    assert scores == {1: (7, 5), 2: (5, 0), 3: (2, 0), 4: (2, 24), 5: (0, 0)}


def test_crm_cases_and_detail(requests):
    flags = crm.crm_flags(requests, "2026-06-25")
    cases = crm.problem_cases(flags).collect()
    assert [r["request_id"] for r in cases] == [1, 2, 3]
    assert cases[0]["problem"] == "просрочено следующее действие; статус давно не менялся; высокий приоритет"
    assert cases[1]["manager"] == "Не назначен" and cases[0]["manager"] == "Анна"
    detail = by(crm.problem_detail(flags, "2026-06-25"), "request_id")
    assert detail[1]["problem"] == "Критично: просрочено действие по горячей заявке"
    assert detail[3]["problem"] == "Просрочен дедлайн закрытия"
    assert [r["request_id"] for r in crm.top_cases(crm.problem_cases(flags), 1).collect()] == [1]


def test_crm_managers(requests):
    flags = crm.crm_flags(requests, "2026-06-25")
    simple = by(crm.by_manager(flags), "manager")
    assert simple["Олег"]["open_requests"] == 2 and simple["Не назначен"]["risk_amount"] == 100.0
    created = by(crm.by_manager_created(flags, "2026-06-25"), "manager")
    assert created["Олег"]["open_requests"] == 1 and created[""]["without_manager"] == 1


def test_crm_trend_equals_a_count_per_day(requests):
    flags = crm.crm_flags(requests, "2026-06-25")
    trend = {r["date"]: r["overdue"] for r in crm.overdue_trend(flags, "2026-06-25").collect()}
    rows = [r for r in flags.collect() if r["is_open"] and r["next_action_due_at"]]
    for offset in range(7):
        d = day("2026-06-25") - dt.timedelta(days=offset)
        end = dt.datetime.combine(d, dt.time(23, 59, 59))
        assert trend[d] == sum(r["created_at"] <= end and r["next_action_due_at"] <= end for r in rows)


def test_crm_alerts(requests):
    flags = crm.crm_flags(requests, "2026-06-25")
    messages = [r["message"] for r in crm.crm_alerts(flags).collect()]
    assert messages[0] == "Высокоприоритетных просрочек: 1" and messages[-1] == "Сумма в зоне риска: 200 100 ₽"
    quiet = crm.crm_flags(requests.filter("request_id = 5"), "2026-06-25")
    assert [r["code"] for r in crm.crm_alerts(quiet).collect()] == ["none"]


# --- charts -----------------------------------------------------------------------------------

def test_metric_by_period_and_dynamics(spark):
    df = spark.createDataFrame(
        [(day("2026-01-05"), 10, 1, 5.0, 4, 2, 0), (day("2026-01-11"), 5, 0, 0.0, 0, 0, 1), (day("2026-01-12"), 30, 2, 8.0, 0, 0, 1)],
        "date date, visits int, orders int, revenue double, units int, paid_units int, installs int",
    )
    weeks = {r["period"]: r["value"] for r in charts.metric_by_period(df, "week", "visits").collect()}
    changes = charts.metric_dynamics(df, "week", ["visits"]).orderBy("period")
    chosen = charts.metric_by_period(df, "week", "visits_dynamics")
    assert [tuple(r) for r in chosen.collect()] == [(r["period"], r["dynamics_pct"]) for r in changes.collect()]
    assert weeks == {day("2026-01-05"): 15.0, day("2026-01-12"): 30.0}
    moved = by(charts.metric_dynamics(df, "week"), "metric", "period")
    assert moved[("visits", day("2026-01-12"))]["dynamics_pct"] == 100.0
    assert moved[("visits", day("2026-01-05"))]["dynamics_pct"] is None
    assert moved[("buyout_rate", day("2026-01-05"))]["value"] == 0.5
    with pytest.raises(ValueError):
        charts.metrics_by_period(df, "week", ["nope"])


def test_plan_fact(spark):
    fact = spark.createDataFrame(
        [(day("2026-01-05"), "a", 10.0, 100.0), (day("2026-01-09"), "a", 10.0, 100.0), (day("2026-01-06"), "b", 5.0, 0.0)],
        "date date, channel string, cost double, revenue double",
    )
    plan = spark.createDataFrame([("a", 8.0, 50.0), ("c", 1.0, 10.0)], "channel string, day_total_cost double, day_revenue_plan double")
    rows = by(charts.plan_fact(fact, plan, "2026-01-05", "2026-01-11", "2026-01-07", vat=1.2), "channel")
    assert (rows["a"]["budget_plan"], rows["a"]["budget_fact"], rows["a"]["drr_plan"], rows["a"]["drr_fact"]) == (24.0, 12.0, 0.16, 0.12)
    assert (rows["b"]["budget_plan"], rows["b"]["drr_fact"]) == (0.0, None)
    assert (rows["Total"]["budget_plan"], rows["Total"]["budget_fact"], rows["Total"]["is_total"]) == (27.0, 18.0, 1)


def test_plan_before_the_period_is_zero(spark):
    fact = spark.createDataFrame([], "date date, channel string, cost double, revenue double")
    plan = spark.createDataFrame([("a", 8.0, 50.0)], "channel string, day_total_cost double, day_revenue_plan double")
    rows = by(charts.plan_fact(fact, plan, "2026-01-05", "2026-01-11", "2026-01-01"), "channel")
    assert rows["a"]["budget_plan"] == 0.0


def test_brand_split(spark):
    df = spark.createDataFrame([("direct", "brand x"), ("direct", "other"), ("vk", "brand")], "channel string, campaign string")
    named = charts.split_brand(df, "direct", F.col("campaign").startswith("brand"))
    assert [r["channel"] for r in named.collect()] == ["direct brand", "direct non-brand", "vk"]
