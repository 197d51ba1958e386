"""Adapters from the sample tables to the inputs of the marts.

Each function maps whole tables row by row. Derived attributes use integer arithmetic on
the keys, so the same rule can be written in any SQL dialect.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesloom.schemas import SAMPLE_TABLES


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(SAMPLE_TABLES[name]).parquet(f"{folder}/{name}.parquet")


def _text(prefix: str, value: Column) -> Column:
    return F.concat(F.lit(prefix), value.cast("string"))


def _days_after(start: Column, days: Column) -> Column:
    return start + F.make_dt_interval(days.cast("int"))


def _div(value: Column, by) -> Column:
    """Whole-number quotient of non-negative integers."""
    return ((value - value % by) / by).cast("bigint")


def _choice(value: Column, options: dict, otherwise=None) -> Column:
    result = None
    for key, option in options.items():
        option = option if isinstance(option, Column) else F.lit(option)
        result = F.when(value == key, option) if result is None else result.when(value == key, option)
    return result.otherwise(otherwise if isinstance(otherwise, Column) else F.lit(otherwise))


# --- events: ads, attribution, notifications ----------------------------------------

def ads_events(spark: SparkSession, folder: str) -> DataFrame:
    """One row per ad event, with 0/1 counters and amounts."""
    e = table(spark, folder, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    kind = F.col("event_type")
    return e.select(
        "event_id",
        F.to_date("ts").alias("stat_date"),
        _text("src", F.col("user_id") % 4).alias("source"),
        _text("c", k % 8).alias("campaign"),
        _choice(kind, {"signup": "lead", "purchase": "purchase", "view": "view", "click": "click"}, "other").alias("event_name"),
        (kind == "view").cast("bigint").alias("impressions"),
        (kind == "click").cast("bigint").alias("clicks"),
        F.when(kind == "click", F.col("value")).otherwise(0.0).alias("cost"),
        (kind == "signup").cast("bigint").alias("leads"),
        (kind == "purchase").cast("bigint").alias("orders"),
        F.when(kind == "purchase", F.col("value")).otherwise(0.0).alias("revenue"),
    ).filter("event_name <> 'other'")


def ad_spend(spark: SparkSession, folder: str) -> DataFrame:
    a = ads_events(spark, folder).filter(F.col("event_name").isin("view", "click"))
    return a.select(
        F.col("stat_date").alias("date"), F.col("source").alias("channel"), "campaign", "impressions", "clicks", "cost"
    )


def crm_leads(spark: SparkSession, folder: str) -> DataFrame:
    e = table(spark, folder, "events").filter("event_type = 'signup'")
    k = F.get_json_object("props", "$.k").cast("int")
    won = F.col("event_id") % 3 == 0
    return e.select(
        F.col("event_id").cast("string").alias("lead_id"),
        F.col("ts").alias("created_at"),
        _text("src", F.col("user_id") % 4).alias("channel"),
        _text("c", k % 8).alias("campaign"),
        F.when(won, "won").otherwise("new").alias("status"),
        F.when(won, F.col("event_id").cast("string")).otherwise("").alias("order_id"),
    )


def paid_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Every third event stands for a paid order with the event's own id."""
    e = table(spark, folder, "events").filter(F.col("event_id") % 3 == 0)
    return e.select(
        F.col("event_id").cast("string").alias("order_id"),
        F.col("ts").alias("paid_at"),
        (F.col("value") * 10).alias("revenue"),
        F.lit(0.3).alias("gross_margin"),
    )


_PARTNERS = {0: "Scaleio Network", 1: "Perfluence", 2: "Unknown (source: Advertisement Engine)"}
_TRACKERS = {0: "Scaleo_main", 1: "perfluence_app"}
_PARAMETERS = {
    0: "source=scaleo",
    1: "",
    2: "utm=scaleo&type=cpa",
    3: "source=admitad",
    4: "source=advcake",
    5: "source=cityads",
}


def installs(spark: SparkSession, folder: str) -> DataFrame:
    """Every signup is an install, so a user has several; one user in five has none."""
    e = table(spark, folder, "events").filter("event_type = 'signup' AND user_id % 5 <> 0")
    k = F.get_json_object("props", "$.k").cast("int") % 6
    return e.select(
        F.col("ts").alias("install_datetime"),
        F.col("user_id").cast("string").alias("installation_id"),
        _text("dev", F.col("user_id")).alias("appmetrica_device_id"),
        _choice(k, _PARTNERS, "Organic").alias("publisher_name"),
        _choice(k, _TRACKERS, _text("tracker", k)).alias("tracker_name"),
        _choice(k, _PARAMETERS).alias("click_url_parameters"),
        F.when(F.col("user_id") % 2 == 0, "ios").otherwise("android").alias("os_name"),
    )


def purchases(spark: SparkSession, folder: str) -> DataFrame:
    """Purchase events; up to three of them carry the same order id."""
    e = table(spark, folder, "events").filter("event_type = 'purchase'")
    return e.select(
        F.col("ts").alias("event_datetime"),
        F.col("user_id").cast("string").alias("installation_id"),
        _text("dev", F.col("user_id")).alias("appmetrica_device_id"),
        _div(F.col("event_id"), 3).cast("string").alias("ecom_order_id"),
    )


def crm_orders(spark: SparkSession, folder: str) -> DataFrame:
    o = table(spark, folder, "orders")
    status = F.col("o_orderstatus")
    skus = 1 + F.col("o_orderkey") % 5
    return o.select(
        F.col("o_orderkey").cast("string").alias("increment_id"),
        _choice(status, {"F": "complete", "O": "processing"}, "canceled").alias("status"),
        F.col("o_totalprice").alias("sum_zakaza"),
        F.when(status == "F", F.col("o_totalprice")).alias("sum_oplaty"),
        F.when(status == "P", F.col("o_totalprice")).otherwise(0.0).alias("sum_vozvrata"),
        skus.cast("int").alias("aty_sku_zakaza"),
        F.when(status == "F", skus).otherwise(0).cast("int").alias("aty_sku_oplaty"),
        (F.col("o_custkey") % 4 == 0).cast("int").alias("customer_is_new"),
        _days_after(F.lit("2024-01-01").cast("timestamp_ntz"), F.col("o_orderkey") % 45).alias("created_at_msk"),
    )


def both_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders seen in two systems, with the system that wins."""
    o = table(spark, folder, "orders")
    return o.filter(F.col("o_orderkey") % 9 < 2).select(
        F.col("o_orderkey").cast("string").alias("purchase_id"),
        F.when(F.col("o_orderkey") % 9 == 0, "web").otherwise("app").alias("flag"),
    )


def web_to_app(spark: SparkSession, folder: str) -> DataFrame:
    o = table(spark, folder, "orders").filter(F.col("o_orderkey") % 7 == 0)
    even = F.col("o_orderkey") % 2 == 0
    return o.select(
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.when(even, "Perfluence").otherwise("Direct").alias("publisher_name"),
        F.when(even, "w2a_perfluence").otherwise("w2a_banner").alias("tracker_name"),
        F.when(even, "source=perfluence").otherwise("source=admitad").alias("url_params"),
    )


def notification_events(spark: SparkSession, folder: str) -> DataFrame:
    e = table(spark, folder, "events")
    kind = F.col("event_type")
    return e.select(
        _text("E-", F.col("event_id")).alias("event_id"),
        F.col("ts").alias("created_at"),
        F.col("event_type"),
        F.concat(F.lit("Event "), kind).alias("title"),
        _text("U-", F.col("user_id")).alias("entity_id"),
        _choice(kind, {"error": "critical", "purchase": "high", "signup": "normal"}, "other").alias("priority"),
        _text("team", F.col("user_id") % 5).alias("responsible"),
        F.when(F.col("event_id") % 5 == 0, "queued").otherwise("sent").alias("status"),
        F.lit("telegram").alias("channel"),
        F.col("props").alias("message"),
    )


def notification_rules(spark: SparkSession) -> DataFrame:
    rows = [("view", 0), ("click", 1), ("signup", 1), ("purchase", 1), ("error", 1)]
    return spark.createDataFrame(rows, "event_type string, enabled int")


def ad_plan(spark: SparkSession, folder: str) -> DataFrame:
    """Daily plan per channel that occurs in the events, and one channel without facts."""
    users = table(spark, folder, "events").select((F.col("user_id") % 4).alias("n")).distinct()
    extra = users.agg((F.max("n") + 1).alias("n"))
    n = F.col("n")
    return users.unionByName(extra).select(
        _text("src", n).alias("channel"),
        (100.0 + 10 * n).alias("day_total_cost"),
        (300.0 + 50 * n).alias("day_revenue_plan"),
    )


# --- orders, line items, customers, parts ---------------------------------------------

def sales_orders(spark: SparkSession, folder: str) -> DataFrame:
    o = table(spark, folder, "orders")
    c = table(spark, folder, "customer").select("c_custkey", "c_mktsegment")
    status = _choice(F.col("o_orderstatus"), {"F": " Paid", "O": "completed"}, "cancelled")
    return o.join(c, F.col("o_custkey") == F.col("c_custkey"), "left").select(
        F.to_date("o_orderdate").alias("order_date"),
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        status.alias("status"),
        F.col("o_orderpriority").alias("channel"),
        F.col("c_mktsegment").alias("category"),
        F.col("o_totalprice").alias("revenue"),
        (F.col("o_custkey") % 4 == 0).alias("is_new_client"),
    )


def _unit_price() -> Column:
    """Price of one piece, cut off after the cents."""
    cents = F.rint(F.col("l_extendedprice") * 100).cast("bigint")
    return _div(cents, F.col("l_quantity").cast("bigint")) / F.lit(100.0)


def order_items(spark: SparkSession, folder: str) -> DataFrame:
    li = table(spark, folder, "lineitem")
    return li.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_linenumber").alias("line_no"),
        F.col("l_suppkey").alias("supplier_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        _unit_price().alias("unit_price"),
        F.col("l_discount").alias("discount_pct"),
    )


def mart_orders(spark: SparkSession, folder: str) -> DataFrame:
    o = table(spark, folder, "orders")
    return o.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.to_date("o_orderdate").alias("order_date"),
        F.col("o_orderpriority").alias("sales_channel"),
        F.when(F.col("o_orderkey") % 3 == 0, "card").otherwise("invoice").alias("payment_method"),
        _choice(F.col("o_orderstatus"), {"F": "paid", "O": "refunded"}, "cancelled").alias("order_status"),
        _text("m", F.col("o_custkey") % 40).alias("manager"),
    )


def mart_customers(spark: SparkSession, folder: str) -> DataFrame:
    c = table(spark, folder, "customer")
    n = table(spark, folder, "nation").select("n_nationkey", "n_name")
    return c.join(n, F.col("c_nationkey") == F.col("n_nationkey"), "left").select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        F.col("n_name").alias("city"),
        F.when(F.col("c_custkey") % 2 == 0, "B2B").otherwise("B2C").alias("customer_type"),
    )


def mart_products(spark: SparkSession, folder: str) -> DataFrame:
    p = table(spark, folder, "part")
    return p.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        (F.col("p_retailprice") * 0.6).alias("unit_cost"),
    )


def report_orders(spark: SparkSession, folder: str) -> DataFrame:
    o = table(spark, folder, "orders")
    return o.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("created_at"),
        _choice(F.col("o_orderstatus"), {"F": "paid", "O": "shipped"}, "new").alias("status"),
        F.col("o_orderpriority").alias("channel"),
        _text("city", F.col("o_custkey") % 25).alias("city"),
        (F.col("o_custkey") % 100).alias("manager_id"),
    )


def report_items(spark: SparkSession, folder: str) -> DataFrame:
    li = table(spark, folder, "lineitem")
    return li.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        _unit_price().alias("price"),
        (F.col("l_extendedprice") * F.col("l_discount")).alias("discount"),
    )


def report_products(spark: SparkSession, folder: str) -> DataFrame:
    p = table(spark, folder, "part")
    return p.select(
        F.col("p_partkey").alias("product_id"),
        _choice(F.col("p_type"), {"PROMO": "test", "SMALL": "demo"}, F.col("p_type")).alias("category"),
    )


def managers(spark: SparkSession, folder: str) -> DataFrame:
    s = table(spark, folder, "supplier")
    return s.select(
        F.col("s_suppkey").alias("manager_id"),
        F.col("s_name").alias("manager_name"),
        _text("dep", F.col("s_nationkey") % 5).alias("department"),
    )


def crm_requests(spark: SparkSession, folder: str) -> DataFrame:
    o = table(spark, folder, "orders")
    key, start = F.col("o_orderkey"), F.col("o_orderdate")
    return o.select(
        key.alias("request_id"),
        start.alias("created_at"),
        _days_after(start, key % 7).alias("status_updated_at"),
        F.when(key % 11 != 0, _days_after(start, key % 5)).alias("next_action_due_at"),
        _days_after(start, F.lit(10)).alias("close_due_at"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("priority"),
        _text("s", key % 6).alias("source"),
        F.when(F.col("o_custkey") % 13 == 0, "").otherwise(_text("m", F.col("o_custkey") % 40)).alias("manager"),
        _text("client ", F.col("o_custkey")).alias("client"),
        F.col("o_totalprice").alias("amount"),
    )


MARKETPLACES = ("market-a", "market-b", "market-c")


def marketplace_stocks(spark: SparkSession, folder: str) -> list[DataFrame]:
    """One stock table per marketplace."""
    p = table(spark, folder, "part")
    key = F.col("p_partkey")
    frames = []
    for i, name in enumerate(MARKETPLACES):
        frames.append(
            p.select(
                F.lit(name).alias("marketplace"),
                _text("sku-", key).alias("sku"),
                F.lit(f"wh{i}").alias("warehouse"),
                F.col("p_size").cast("bigint").alias("stock"),
                ((key + i) % 5).cast("bigint").alias("reserved"),
                F.col("p_retailprice").alias("price"),
                ((10 + key % 10) / F.lit(100.0)).alias("commission_rate"),
                F.when(key % 20 == 0, "paused").otherwise("active").alias("status"),
            )
        )
    return frames


def stock_products(spark: SparkSession, folder: str) -> DataFrame:
    p = table(spark, folder, "part")
    percent = 60 + F.col("p_partkey") % 25
    return p.select(
        _text("sku-", F.col("p_partkey")).alias("sku"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        (F.col("p_retailprice") * percent / F.lit(100.0)).alias("cost_price"),
    )


def stock_orders(spark: SparkSession, folder: str) -> DataFrame:
    li = table(spark, folder, "lineitem")
    market = F.element_at(F.array(*[F.lit(m) for m in MARKETPLACES]), (F.col("l_suppkey") % 3 + 1).cast("int"))
    return li.select(
        F.to_date("l_shipdate").alias("date"),
        market.alias("marketplace"),
        _text("sku-", F.col("l_partkey")).alias("sku"),
        F.lit(1).cast("bigint").alias("orders"),
        F.col("l_extendedprice").alias("revenue"),
    )


def _messy_phone(key: Column) -> Column:
    digits = (F.lit(9_000_000_000) + key).cast("string")
    return _choice(
        key % 4,
        {
            0: F.concat(F.lit("8"), digits),
            1: F.concat(
                F.lit("+7 ("), F.substring(digits, 1, 3), F.lit(") "), F.substring(digits, 4, 3),
                F.lit("-"), F.substring(digits, 7, 2), F.lit("-"), F.substring(digits, 9, 2),
            ),
            2: digits,
        },
        F.concat(F.lit("12-"), key.cast("string")),
    )


def _messy_email(key: Column) -> Column:
    return _choice(
        key % 3,
        {
            0: F.concat(F.lit(" Client."), key.cast("string"), F.lit("@Example.COM ")),
            1: F.concat(F.lit("client "), key.cast("string"), F.lit("@example.com")),
        },
        F.concat(F.lit("клиент"), key.cast("string"), F.lit("@example.com")),
    )


def dirty_clients(spark: SparkSession, folder: str) -> DataFrame:
    """Every customer, and a second, differently written record for one in six."""
    c = table(spark, folder, "customer")
    n = table(spark, folder, "nation").select("n_nationkey", "n_name")
    base = c.join(n, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    key = F.col("c_custkey")

    def records(source: DataFrame, copy: int) -> DataFrame:
        registered = F.date_add(F.lit("2020-01-01").cast("date"), (key % 1000).cast("int"))
        ordered = F.date_add(F.lit("2023-01-01").cast("date"), (key % 300 + 10 * copy).cast("int"))
        return source.select(
            (key * 2 + copy).alias("row_no"),
            _text("C", key * 2 + copy).alias("client_id"),
            F.concat(F.lit(" пётр-иван  " if copy else "ПЕТР-Иван "), F.translate("c_name", "#", " ")).alias("full_name"),
            _messy_phone(key).alias("phone"),
            (F.lit(None).cast("string") if copy else _messy_email(key)).alias("email"),
            F.translate("n_name", "_", "-").alias("city"),
            F.lit("import" if copy else "site").alias("source"),
            registered.alias("registered_at"),
            F.when(key % 5 != 0, ordered).alias("last_order_at"),
            (key % 9 + copy).cast("int").alias("total_orders"),
            F.col("c_acctbal").alias("revenue_rub"),
            F.when(key % 3 == 0, "gold").otherwise("").alias("loyalty_level"),
            (key % 2).cast("int").alias("consent_email"),
            F.lit(copy).alias("consent_sms"),
        )

    return records(base, 0).unionByName(records(base.filter(key % 6 == 0), 1))


def _lead_start(key: Column) -> Column:
    return _days_after(F.lit("2024-01-01").cast("timestamp_ntz"), key % 30)


def lead_forms(spark: SparkSession, folder: str) -> DataFrame:
    c = table(spark, folder, "customer")
    key = F.col("c_custkey")
    return c.select(
        key.alias("form_id"),
        _lead_start(key).alias("created_at"),
        F.when(key % 17 == 0, "X").otherwise(F.col("c_name")).alias("name"),
        _messy_phone(key).alias("phone"),
        F.when(key % 19 == 0, "no-address").otherwise(F.concat(F.lit("c"), key.cast("string"), F.lit("@example.com"))).alias("email"),
        F.when(key % 23 == 0, " ").otherwise(F.col("c_mktsegment")).alias("service"),
        F.when(key % 97 == 0, F.repeat(F.lit("x"), F.lit(2001))).otherwise(_text("note ", key)).alias("comment"),
        _text("utm", F.col("c_nationkey") % 4).alias("utm_source"),
        F.lit("cpc").alias("utm_medium"),
        _text("camp", F.col("c_nationkey") % 3).alias("utm_campaign"),
        F.when(key % 2 == 0, "").otherwise(_text("/p/", key)).alias("page_url"),
    )


def lead_log(spark: SparkSession, folder: str) -> DataFrame:
    """Appended lead rows: one when the form arrives, a second one with the outcome."""
    c = table(spark, folder, "customer")
    key = F.col("c_custkey")

    def version(n: int, crm: Column, chat: Column, sheet: Column) -> list[Column]:
        return [
            _text("L-", key).alias("lead_id"),
            F.lit(n).alias("version"),
            _lead_start(key).alias("created_at"),
            F.col("c_mktsegment").alias("service"),
            _text("utm", F.col("c_nationkey") % 4).alias("utm_source"),
            crm.alias("crm_status"),
            chat.alias("telegram_status"),
            sheet.alias("sheets_status"),
        ]

    queued = F.lit("queued")
    outcome = {0: "sent", 1: "skipped"}
    first = c.select(*version(1, queued, queued, queued))
    final = c.filter(key % 10 != 0).select(
        *version(2, _choice(key % 3, outcome, "error"), _choice(key % 4, outcome, "error"), _choice(key % 5, outcome, "error"))
    )
    return first.unionByName(final)


def bot_leads(spark: SparkSession, folder: str) -> DataFrame:
    c = table(spark, folder, "customer")
    key = F.col("c_custkey")
    return c.select(
        _text("B-", key).alias("lead_id"),
        _lead_start(key).alias("created_at"),
        F.concat(F.lit(" "), F.col("c_name")).alias("name"),
        _messy_phone(key - key % 2).alias("phone"),
        F.when(key % 19 == 0, "no address").otherwise(F.concat(F.lit("C"), key.cast("string"), F.lit("@Example.com"))).alias("email"),
        F.col("c_mktsegment").alias("service"),
        _text("до ", F.lit(50) * (1 + key % 3)).alias("budget"),
        _text("note ", key).alias("comment"),
        F.when(key % 7 == 0, "").otherwise(_choice(key % 3, {0: "new", 1: "in_work"}, "done")).alias("status"),
        F.when(key % 4 == 0, "").otherwise(_text("m", key % 5)).alias("manager"),
    )


def service_catalogue(spark: SparkSession, folder: str) -> DataFrame:
    """The segments on offer; one of them is no longer sold."""
    c = table(spark, folder, "customer")
    return c.filter("c_mktsegment <> 'FURNITURE'").select(F.col("c_mktsegment").alias("service")).distinct()


# --- conversations, FAQ -----------------------------------------------------------------

def questions(spark: SparkSession, folder: str) -> DataFrame:
    """Every user turn is a question."""
    t = table(spark, folder, "conversations").filter("role = 'user'")
    return t.select(
        F.concat(F.col("conv_id").cast("string"), F.lit("-"), F.col("turn").cast("string")).alias("question_id"),
        _lead_start(F.col("conv_id")).alias("created_at"),
        F.when(F.col("conv_id") % 6 == 0, " ").otherwise(_text("user ", F.col("conv_id"))).alias("client_name"),
        F.lit("telegram").alias("channel"),
        F.when(F.col("conv_id") % 25 == 24, "Связаться с оператором").otherwise(F.col("text")).alias("question"),
    )


def faq_items(spark: SparkSession, folder: str) -> DataFrame:
    b = table(spark, folder, "benchmark")
    return b.select(
        "item_id",
        _text("item", F.col("item_id")).alias("intent"),
        F.col("text").alias("question"),
        _text("answer ", F.col("item_id")).alias("answer"),
        _text("c", F.col("item_id") % 5).alias("category"),
    )


# --- contacts ---------------------------------------------------------------------------

def _lon_lat(key: Column, nation: Column) -> Column:
    """"lon lat" near the centre of a nation, with three decimals."""
    lon = F.concat((30 + nation).cast("string"), F.lit("."), F.lpad((key * 7 % 1000).cast("string"), 3, "0"))
    lat = F.concat((45 + nation % 10).cast("string"), F.lit("."), F.lpad((key * 13 % 1000).cast("string"), 3, "0"))
    return F.concat(lon, F.lit(" "), lat)


def contact_sheet(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of a contact sheet with the geocoder's reply; two rows share a number."""
    c = table(spark, folder, "customer")
    n = table(spark, folder, "nation").select("n_nationkey", "n_name")
    key = F.col("c_custkey")
    area = F.concat(F.lit('{"kind":"area","name":"D'), (key % 12).cast("string"), F.lit('"}'))
    components = F.when(key % 10 == 2, F.lit('{"kind":"street","name":"S"}')).otherwise(
        F.concat(F.lit('{"kind":"country","name":"X"},'), area)
    )
    reply = F.concat(
        F.lit('{"response":{"GeoObjectCollection":{"featureMember":[{"GeoObject":{"Point":{"pos":"'),
        _lon_lat(key, F.col("c_nationkey")),
        F.lit('"},"metaDataProperty":{"GeocoderMetaData":{"Address":{"Components":['),
        components,
        F.lit("]}}}}}]}}}"),
    )
    empty = '{"response":{"GeoObjectCollection":{"featureMember":[]}}}'
    return c.join(n, F.col("c_nationkey") == F.col("n_nationkey"), "left").select(
        key.alias("row_no"),
        _text("N", _div(key, 2)).alias("number"),
        _messy_phone(key).alias("phone"),
        F.col("c_name").alias("name"),
        _text("patronymic ", key % 7).alias("patronymic"),
        F.when(key % 5 != 0, _text("surname ", key)).alias("surname"),
        F.col("c_mktsegment").alias("area"),
        F.col("n_name").alias("city"),
        F.when(key % 6 != 0, _text("street ", key % 50)).alias("street"),
        F.lit("").alias("locality"),
        (key % 90).cast("string").alias("house"),
        F.when(key % 8 == 0, "b1").alias("build"),
        _text("note ", key).alias("comment"),
        _text("2024-01-1", key % 10).alias("date_inst"),
        _choice(key % 2, {0: "yes"}, "no").alias("guarantee"),
        F.when(key % 3 == 0, _text("to ", key % 4)).alias("to1"),
        _text("2025-02-1", key % 10).alias("date_to"),
        _choice(key % 3, {0: "READY", 1: "ready"}, "completed").alias("status"),
        F.when(key % 10 == 0, "{broken").when(key % 10 == 1, empty).otherwise(reply).alias("geocoder_reply"),
    )


def existing_contacts(spark: SparkSession, folder: str) -> DataFrame:
    """Contacts already stored, keyed by ``number``."""
    s = table(spark, folder, "supplier")
    key = F.col("s_suppkey")
    return s.select(
        _text("N", key).alias("number"),
        _messy_phone(key).alias("phone"),
        F.col("s_name").alias("name"),
        F.lit("old patronymic").alias("patronymic"),
        F.lit("old surname").alias("surname"),
        F.lit("old").alias("area"),
        F.lit("old city").alias("city"),
        F.lit("old street").alias("street"),
        F.lit("").alias("locality"),
        F.lit("1").alias("house"),
        F.lit(None).cast("string").alias("build"),
        F.lit("old note").alias("comment"),
        F.lit("2020-01-01").alias("date_inst"),
        F.lit("old guarantee").alias("guarantee"),
        F.lit("old to").alias("to1"),
        F.lit("2021-01-01").alias("date_to"),
        F.lit(None).cast("double").alias("lon"),
        F.lit(None).cast("double").alias("lat"),
        F.lit(None).cast("string").alias("district"),
    )


def route_stops(spark: SparkSession, folder: str) -> DataFrame:
    n = table(spark, folder, "nation")
    return n.select(
        F.col("n_name").alias("stop"),
        (45.5 + F.col("n_nationkey") % 10).alias("lat"),
        (30.5 + F.col("n_nationkey")).alias("lon"),
    )
