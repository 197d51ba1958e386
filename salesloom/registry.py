"""Query keys bound to the sample tables with fixed report dates."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesloom import fixed_values as fv
from salesloom.functions.numbers import rounded
from salesloom.operators.joins import hot_keys
from salesloom.plans import (
    ad_sales,
    ads_report,
    attribution,
    charts,
    clients,
    contacts,
    cpa,
    crm,
    leads,
    notifications,
    order_states,
    orders_report,
    sales_mart,
    sales_report,
    stock,
    support,
)
from salesloom.session import tune
from salesloom.sources import bindings as b
from salesloom.sources.files import date_slice

Query = Callable[[SparkSession, str], DataFrame]

ORDERS_FROM, ORDERS_TO = "1998-06-01", "1998-07-01"
SALES_DAY = "1998-06-30"
ADS_DAY = "2024-01-15"
STOCK_FROM, STOCK_TO = "1998-06-28", "1998-06-30"
TIEBREAK = ("line_no", "product_id", "supplier_id")
# Limits that fit the amounts of the sample events.
ADS_LIMITS = {"target_cpa": 60, "min_roas": 1.0, "min_cost": 100}


# --- order report ---------------------------------------------------------------------

def _orders_report(s: SparkSession, d: str, **options) -> DataFrame:
    return orders_report.orders_report(
        b.report_orders(s, d), b.report_items(s, d), b.managers(s, d), ORDERS_FROM, ORDERS_TO, **options
    )


def _orders_report_lean(s: SparkSession, d: str) -> DataFrame:
    return _orders_report(s, d)


def _orders_report_filtered(s: SparkSession, d: str) -> DataFrame:
    return _orders_report(s, d, products=b.report_products(s, d), exclude_categories=fv.EXCLUDED_CATEGORIES)


def _orders_report_heavy(s: SparkSession, d: str) -> DataFrame:
    return orders_report.orders_report_heavy(
        b.report_orders(s, d), b.report_items(s, d), b.report_products(s, d), b.managers(s, d), ORDERS_FROM, ORDERS_TO
    )


# --- sales mart -------------------------------------------------------------------------

def _detail(s: SparkSession, d: str) -> DataFrame:
    return sales_mart.sales_detail(
        b.order_items(s, d), b.mart_orders(s, d), b.mart_customers(s, d), b.mart_products(s, d)
    )


def _order_sequence(s: SparkSession, d: str) -> DataFrame:
    return sales_mart.order_sequence(
        b.mart_orders(s, d), sales_mart.order_totals(b.order_items(s, d), b.mart_products(s, d))
    )


def _item_sequence(s: SparkSession, d: str) -> DataFrame:
    items = b.order_items(s, d).select("order_id", "product_id", "line_no", "supplier_id")
    return sales_mart.item_sequence(items, b.mart_orders(s, d), TIEBREAK)


def _daily_kpis(s: SparkSession, d: str) -> DataFrame:
    states = order_states.order_states_in_one_step(b.order_items(s, d), b.mart_products(s, d))
    return order_states.daily_kpis(states, b.mart_orders(s, d))


def _states(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    return order_states.order_states(b.order_items(s, d), b.mart_products(s, d)), b.mart_orders(s, d)


def _sales_view(s: SparkSession, d: str) -> DataFrame:
    """SQL over the named view: sales per month and category, which needs no customer and no totals."""
    sales_mart.create_sales_view(
        "dashboard_sales_dataset", b.order_items(s, d), b.mart_orders(s, d), b.mart_customers(s, d), b.mart_products(s, d)
    )
    return s.sql(
        """SELECT order_month, category, count(*) AS lines, sum(quantity) AS sold_units,
        count_if(is_paid = 1) AS paid_lines FROM dashboard_sales_dataset GROUP BY order_month, category"""
    )


def _sales_view_rows(s: SparkSession, d: str) -> DataFrame:
    return sales_mart.create_sales_view(
        "dashboard_sales_dataset", b.order_items(s, d), b.mart_orders(s, d), b.mart_customers(s, d), b.mart_products(s, d)
    )


def _paid_lines(s: SparkSession, d: str) -> DataFrame:
    return order_states.paid_lines(b.order_items(s, d), b.mart_orders(s, d), b.mart_products(s, d))


def _lookup_violations(s: SparkSession, d: str) -> DataFrame:
    return sales_mart.lookup_violations(
        {
            "orders": (b.mart_orders(s, d), ["order_id"]),
            "products": (b.mart_products(s, d), ["product_id"]),
            "customers": (b.mart_customers(s, d), ["customer_id"]),
            "order_items": (b.order_items(s, d), ["order_id", "product_id"]),
        }
    )


SALES_QUERIES: dict[str, Query] = {
    "orders_report_optimized": _orders_report_lean,
    "orders_report_without_categories": _orders_report_filtered,
    "orders_report_heavy": _orders_report_heavy,
    "sales_detail": _detail,
    "sales_view": _sales_view_rows,
    "sales_view_by_month": _sales_view,
    "order_sequence": _order_sequence,
    "item_sequence": _item_sequence,
    "sales_daily_metrics": lambda s, d: order_states.daily_metrics(*_states(s, d)),
    "sales_daily_kpi_sql": _daily_kpis,
    "category_metrics": lambda s, d: sales_mart.line_category_metrics(_paid_lines(s, d)),
    "customer_metrics": lambda s, d: order_states.customer_metrics(*_states(s, d), b.mart_customers(s, d)),
    "lookup_key_violations": _lookup_violations,
    "sales_overall_kpis": lambda s, d: order_states.overall_kpis(*_states(s, d)),
    "sales_last_14_days": lambda s, d: sales_mart.last_days(order_states.daily_metrics(*_states(s, d))),
    "top_categories": lambda s, d: sales_mart.top_line_categories(_paid_lines(s, d)),
    "sales_data_dictionary": lambda s, d: sales_mart.dictionary_profile(_detail(s, d), fv.SALES_DICTIONARY),
    "sales_daily_kpis": lambda s, d: sales_report.daily_kpis(b.sales_orders(s, d), SALES_DAY),
    "sales_by_channel": lambda s, d: sales_report.by_channel(b.sales_orders(s, d), SALES_DAY),
    "sales_by_category": lambda s, d: sales_report.by_category(b.sales_orders(s, d), SALES_DAY),
    "sales_channel_day": lambda s, d: sales_report.channel_day(b.sales_orders(s, d), SALES_DAY),
    "sales_alerts": lambda s, d: sales_report.sales_alerts(b.sales_orders(s, d), SALES_DAY),
}


# --- ads ----------------------------------------------------------------------------------

def _ads(s: SparkSession, d: str) -> DataFrame:
    return b.ads_events(s, d).withColumnRenamed("stat_date", "date")


def _ad_sales(s: SparkSession, d: str) -> DataFrame:
    return ad_sales.ad_sales_report(b.ad_spend(s, d), b.crm_leads(s, d), b.paid_orders(s, d))


def _chart_input(s: SparkSession, d: str) -> DataFrame:
    """Events as chart metrics; an ordered unit is paid for every second event id."""
    bought = F.col("orders") == 1
    return _ads(s, d).select(
        "date",
        F.col("impressions").alias("visits"),
        "orders",
        "revenue",
        F.when(bought, 1 + F.col("event_id") % 3).otherwise(0).alias("units"),
        F.when(bought & (F.col("event_id") % 2 == 0), 1 + F.col("event_id") % 3).otherwise(0).alias("paid_units"),
        F.col("leads").alias("installs"),
    )


def _plan_fact(s: SparkSession, d: str) -> DataFrame:
    fact = _ads(s, d).select("date", F.col("source").alias("channel"), "campaign", "cost", "revenue")
    brand = F.col("campaign").isin("c1", "c3")
    return charts.plan_fact(
        charts.split_brand(fact, "src0", brand), b.ad_plan(s, d), "2024-01-08", "2024-01-21", ADS_DAY, vat=1.2
    )


ADS_QUERIES: dict[str, Query] = {
    "ad_events_mart": lambda s, d: ads_report.events_mart(b.ads_events(s, d), ADS_DAY),
    "ad_daily_kpis": lambda s, d: ads_report.daily_kpis(_ads(s, d), ADS_DAY),
    "kpi_labels": lambda s, d: ads_report.kpi_labels(_ads(s, d), ADS_DAY),
    "ad_by_source": lambda s, d: ads_report.by_source(_ads(s, d), ADS_DAY),
    "ad_by_campaign": lambda s, d: ads_report.by_campaign(_ads(s, d), ADS_DAY),
    "ad_bad_campaigns": lambda s, d: ads_report.bad_campaigns(_ads(s, d), ADS_DAY, **ADS_LIMITS),
    "top_campaigns": lambda s, d: ads_report.top_campaigns(_ads(s, d), ADS_DAY),
    "ad_alerts": lambda s, d: ads_report.ad_alerts(_ads(s, d), ADS_DAY, **ADS_LIMITS),
    "ad_sales_report": _ad_sales,
    "ad_channel_summary": lambda s, d: ad_sales.channel_summary(_ad_sales(s, d)),
    "ad_channel_messages": lambda s, d: ad_sales.channel_messages(ad_sales.channel_summary(_ad_sales(s, d))),
    "source_date_slice": lambda s, d: date_slice(b.crm_leads(s, d), "created_at", "2024-01-09", "2024-01-15"),
    "metric_by_period": lambda s, d: charts.metrics_by_period(_chart_input(s, d), "week"),
    "metric_revenue_by_month": lambda s, d: charts.metric_by_period(_chart_input(s, d), "month", "revenue"),
    "metric_visits_dynamics": lambda s, d: charts.metric_by_period(_chart_input(s, d), "week", "visits_dynamics"),
    "metric_dynamics": lambda s, d: charts.metric_dynamics(_chart_input(s, d), "day"),
    "plan_fact": _plan_fact,
}


# --- stock --------------------------------------------------------------------------------

def _stock(s: SparkSession, d: str) -> DataFrame:
    return stock.stock_report(
        stock.stock_union(b.marketplace_stocks(s, d)),
        b.stock_orders(s, d),
        b.stock_products(s, d),
        STOCK_FROM,
        STOCK_TO,
        loaded_at="1998-06-30 08:00:00",
    )


def _stock_union(s: SparkSession, d: str) -> DataFrame:
    return stock.stock_union(b.marketplace_stocks(s, d))


STOCK_QUERIES: dict[str, Query] = {
    "stock_union": _stock_union,
    "stock_report": _stock,
    "stock_alerts": lambda s, d: stock.stock_alerts(_stock(s, d)),
    "stock_summary": lambda s, d: stock.stock_summary(_stock(s, d)),
    "stock_alert_messages": lambda s, d: stock.alert_messages(_stock(s, d)),
}


# --- CRM ------------------------------------------------------------------------------------

CRM_HOT = ("1-URGENT",)


def _flags(s: SparkSession, d: str) -> DataFrame:
    return crm.crm_flags(b.crm_requests(s, d), SALES_DAY, closed=("F",), high=("1-URGENT", "2-HIGH"))


CRM_QUERIES: dict[str, Query] = {
    "crm_flags": _flags,
    "crm_problem_cases": lambda s, d: crm.problem_cases(_flags(s, d)),
    "crm_top_cases": lambda s, d: crm.top_cases(crm.problem_cases(_flags(s, d))),
    "crm_metrics": lambda s, d: crm.crm_metrics(_flags(s, d)),
    "crm_by_manager": lambda s, d: crm.by_manager(_flags(s, d)),
    "crm_by_manager_sql": lambda s, d: crm.by_manager_created(_flags(s, d), SALES_DAY),
    "crm_problem_detail": lambda s, d: crm.problem_detail(_flags(s, d), SALES_DAY, hot=CRM_HOT),
    "crm_overdue_trend": lambda s, d: crm.overdue_trend(_flags(s, d), SALES_DAY),
    "crm_alerts": lambda s, d: crm.crm_alerts(_flags(s, d)),
}


# --- clients ----------------------------------------------------------------------------------

def _keyed(s: SparkSession, d: str) -> DataFrame:
    return clients.with_keys(b.dirty_clients(s, d))


CLIENT_QUERIES: dict[str, Query] = {
    "normalize_contacts": lambda s, d: clients.normalize_contacts(b.dirty_clients(s, d)).select(
        "row_no", "client_id", "full_name_clean", "phone_clean", "email_clean", "city_clean"
    ),
    "client_dedup_key": lambda s, d: _keyed(s, d).select("row_no", "client_id", "completeness_score", "duplicate_key"),
    "client_master": lambda s, d: clients.client_master(_keyed(s, d)),
    "client_id_list": lambda s, d: clients.client_id_list(_keyed(s, d)),
    "client_id_list_sql": lambda s, d: clients.client_id_list_simple(b.dirty_clients(s, d)),
    "client_merge_map": lambda s, d: clients.merge_map(_keyed(s, d)),
    "client_duplicate_groups": lambda s, d: clients.duplicate_groups(_keyed(s, d)),
    "client_duplicate_groups_sql": lambda s, d: clients.duplicate_groups_simple(b.dirty_clients(s, d)),
    "client_duplicate_records": lambda s, d: clients.duplicate_records(_keyed(s, d)),
    "client_quality": lambda s, d: clients.client_quality(_keyed(s, d)),
    # A client has merged ids where it has an id at all.
    "data_dictionary": lambda s, d: clients.dictionary_profile(
        clients.client_master(_keyed(s, d)).withColumn("merged_client_ids", F.col("client_id"))
    ),
}


# --- attribution --------------------------------------------------------------------------------

def _attribution(s: SparkSession, d: str, **options) -> DataFrame:
    return attribution.attribution(
        b.installs(s, d), b.purchases(s, d), b.crm_orders(s, d), b.both_orders(s, d), b.web_to_app(s, d), **options
    )


def _clean_purchases(s: SparkSession, d: str) -> DataFrame:
    return attribution.clean_purchases(b.purchases(s, d), b.both_orders(s, d))


def _purchase_crm(s: SparkSession, d: str) -> DataFrame:
    purchases = b.purchases(s, d)
    hot = hot_keys(purchases, "ecom_order_id")
    clean = attribution.clean_purchases(purchases, b.both_orders(s, d), hot)
    return attribution.purchase_crm(clean, b.crm_orders(s, d), hot=hot)


def _dedup(s: SparkSession, d: str) -> DataFrame:
    joined = attribution.attributed_purchases(
        b.installs(s, d), b.purchases(s, d), b.crm_orders(s, d), b.both_orders(s, d)
    )
    return attribution.deduplicate(joined)


ATTRIBUTION_QUERIES: dict[str, Query] = {
    "semi_join_known_orders": lambda s, d: attribution.known_orders(b.crm_orders(s, d), b.purchases(s, d)),
    "attribution_installs": lambda s, d: attribution.clean_installs(b.installs(s, d)),
    "attribution_purchases": _clean_purchases,
    "attribution_purchase_crm": _purchase_crm,
    "attribution_dedup": _dedup,
    "attribution_dataset": lambda s, d: _attribution(s, d, as_of=ADS_DAY),
    "attribution_strict": lambda s, d: _attribution(s, d, strict=True, match="year_month"),
    "cpa_segments": lambda s, d: cpa.cpa_segments(_attribution(s, d)),
}


# --- leads, support, notifications, contacts ----------------------------------------------------

def _validated(s: SparkSession, d: str) -> DataFrame:
    return leads.validate_leads(b.lead_forms(s, d))


def _latest(s: SparkSession, d: str) -> DataFrame:
    return leads.latest_leads(b.lead_log(s, d))


def _bot(s: SparkSession, d: str) -> DataFrame:
    return leads.validate_bot_leads(b.bot_leads(s, d), b.service_catalogue(s, d))


def _faq(s: SparkSession, d: str) -> DataFrame:
    return support.match_faq(b.questions(s, d), b.faq_items(s, d), pattern=r"[\p{L}\p{N}]+")


def _tickets(s: SparkSession, d: str) -> DataFrame:
    return support.support_tickets(b.questions(s, d), _faq(s, d))


def _queue(s: SparkSession, d: str) -> DataFrame:
    return notifications.queued_events(b.notification_events(s, d), b.notification_rules(s))


def _located(s: SparkSession, d: str) -> DataFrame:
    columns = ("row_no", "number", "name", "phone", "city", "lon", "lat", "district")
    return contacts.located(contacts.ready_contacts(b.contact_sheet(s, d))).select(*columns)


EVENT_QUERIES: dict[str, Query] = {
    "lead_validation": _validated,
    "lead_latest": _latest,
    "site_lead_daily": lambda s, d: leads.site_daily(_latest(s, d)),
    "site_lead_summary": lambda s, d: leads.site_summary(_latest(s, d)),
    "site_lead_messages": lambda s, d: leads.site_lead_messages(leads.accepted(_validated(s, d))),
    "bot_lead_validation": _bot,
    "bot_lead_daily": lambda s, d: leads.bot_daily(_bot(s, d)),
    "bot_lead_summary": lambda s, d: leads.bot_summary(_bot(s, d)),
    "bot_lead_messages": lambda s, d: leads.bot_lead_messages(_bot(s, d).filter("is_valid")),
    "faq_match": _faq,
    "support_tickets": _tickets,
    "support_daily": lambda s, d: support.support_daily(_tickets(s, d)),
    "support_summary": lambda s, d: support.support_summary(_tickets(s, d)),
    "support_operator_messages": lambda s, d: support.operator_messages(_tickets(s, d)),
    "notification_queue": lambda s, d: notifications.notification_queue(
        b.notification_events(s, d), b.notification_rules(s)
    ),
    "notification_outbox": lambda s, d: notifications.outbox(_queue(s, d)),
    "notification_mark_sent": lambda s, d: notifications.mark_sent(b.notification_events(s, d), _queue(s, d)),
    "notification_daily": lambda s, d: notifications.daily(b.notification_events(s, d)),
    "notification_summary": lambda s, d: notifications.summary(b.notification_events(s, d)),
    "contacts_ready": lambda s, d: contacts.ready_contacts(b.contact_sheet(s, d)),
    "geocode_parse": lambda s, d: contacts.with_location(b.contact_sheet(s, d)).select(
        "row_no", "number", "lon", "lat", "district"
    ),
    "contacts_upsert": lambda s, d: contacts.upsert_contacts(b.existing_contacts(s, d), b.contact_sheet(s, d)),
    "contacts_nearby": lambda s, d: contacts.contacts_nearby(_located(s, d), b.route_stops(s, d), 40.0).withColumn(
        "distance_km", rounded("distance_km", 3)
    ),
}


def _tuned(query: Query) -> Query:
    return lambda spark, folder: query(tune(spark), folder)


def queries() -> dict[str, Query]:
    registered = {
        **SALES_QUERIES,
        **ADS_QUERIES,
        **STOCK_QUERIES,
        **CRM_QUERIES,
        **CLIENT_QUERIES,
        **ATTRIBUTION_QUERIES,
        **EVENT_QUERIES,
    }
    return {key: _tuned(query) for key, query in registered.items()}
