"""Input schemas. Files are never read with inferred types: phones and ids stay text."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "text": T.StringType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "double": T.DoubleType(),
    "date": T.DateType(),
    "moment": T.TimestampNTZType(),
    "flag": T.BooleanType(),
}


def table(**columns: str) -> T.StructType:
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in columns.items()])


def described(schema: T.StructType, descriptions: dict[str, str]) -> T.StructType:
    """The schema with a description in the metadata of each column that has one."""
    fields = []
    for f in schema:
        metadata = {"description": descriptions[f.name]} if f.name in descriptions else {}
        fields.append(T.StructField(f.name, f.dataType, f.nullable, metadata))
    return T.StructType(fields)


AD_SPEND = table(date="date", channel="text", campaign="text", impressions="long", clicks="long", cost="double")
CRM_LEADS = table(lead_id="text", created_at="moment", channel="text", campaign="text", status="text", order_id="text")
PAID_ORDERS = table(order_id="text", paid_at="moment", revenue="double", gross_margin="double")
ADS_DAILY = table(
    date="date", source="text", campaign="text", impressions="long", clicks="long", cost="double", leads="long",
    orders="long", revenue="double",
)
CRM_REQUESTS = table(
    request_id="long", created_at="moment", status_updated_at="moment", next_action_due_at="moment",
    close_due_at="moment", status="text", priority="text", source="text", manager="text", client="text",
    amount="double",
)
STOCK = table(
    marketplace="text", sku="text", warehouse="text", stock="long", reserved="long", price="double",
    commission_rate="double", status="text",
)
STOCK_ORDERS = table(date="date", marketplace="text", sku="text", orders="long", revenue="double")
STOCK_PRODUCTS = table(sku="text", product_name="text", category="text", cost_price="double")
SALES_ORDERS = table(
    order_date="date", order_id="text", customer_id="text", revenue="double", status="text", channel="text",
    category="text", is_new_client="flag",
)
MART_ORDERS = table(
    order_id="text", customer_id="text", order_date="date", sales_channel="text", payment_method="text",
    order_status="text", manager="text",
)
MART_ITEMS = table(order_id="text", product_id="text", quantity="int", unit_price="double", discount_pct="double")
MART_CUSTOMERS = table(
    customer_id="text", customer_name="text", city="text", customer_type="text", signup_date="date",
    acquisition_channel="text",
)
MART_PRODUCTS = table(product_id="text", product_name="text", category="text", base_price="double", unit_cost="double")
REPORT_ORDERS = table(
    order_id="long", customer_id="long", created_at="moment", status="text", channel="text", city="text",
    manager_id="long",
)
REPORT_ITEMS = table(order_id="long", product_id="long", quantity="int", price="double", discount="double")
REPORT_PRODUCTS = table(product_id="long", category="text", product_name="text")
MANAGERS = table(manager_id="long", manager_name="text", department="text")
DIRTY_CLIENTS = table(
    row_no="long", client_id="text", internal_id="text", full_name="text", phone="text", email="text", city="text",
    source="text", registered_at="date", last_order_at="date", total_orders="int", revenue_rub="double",
    loyalty_level="text", consent_email="int", consent_sms="int",
)
INSTALLS = table(
    install_datetime="moment", installation_id="text", appmetrica_device_id="text", publisher_name="text",
    tracker_name="text", click_url_parameters="text", os_name="text",
)
PURCHASES = table(event_datetime="moment", installation_id="text", appmetrica_device_id="text", ecom_order_id="text")
CRM_ORDERS = table(
    increment_id="text", status="text", sum_zakaza="double", sum_oplaty="double", sum_vozvrata="double",
    aty_sku_zakaza="int", aty_sku_oplaty="int", customer_is_new="int", created_at_msk="moment",
)
BOTH_ORDERS = table(purchase_id="text", flag="text")
WEB_TO_APP = table(order_id="text", publisher_name="text", tracker_name="text", url_params="text")
LEAD_FORMS = table(
    form_id="text", created_at="moment", name="text", phone="text", email="text", service="text", comment="text",
    utm_source="text", utm_medium="text", utm_campaign="text", utm_content="text", utm_term="text", page_url="text",
    referrer="text",
)
BOT_LEADS = table(
    lead_id="text", created_at="moment", name="text", phone="text", email="text", service="text", budget="text",
    comment="text", status="text", manager="text", source="text",
)
SERVICES = table(service_id="text", service_name="text", base_price="double")
FAQ = table(item_id="long", intent="text", question="text", answer="text", category="text")
TICKETS = table(
    ticket_id="text", created_at="moment", client_name="text", channel="text", question="text",
    detected_intent="text", status="text", need_operator="int",
)
NOTIFICATIONS = table(
    event_id="text", created_at="moment", event_type="text", title="text", entity_id="text", priority="text",
    responsible="text", status="text", channel="text", message="text",
)
NOTIFICATION_RULES = table(
    rule_id="text", event_type="text", description="text", priority="text", recipient="text", enabled="int"
)
CONTACT_SHEET = table(
    row_no="long", number="text", phone="text", name="text", patronymic="text", surname="text", area="text",
    city="text", street="text", locality="text", house="text", build="text", comment="text", date_inst="text",
    guarantee="text", to1="text", date_to="text", status="text", geocoder_reply="text",
)

# --- sample tables ------------------------------------------------------------------

SAMPLE_TABLES = {
    "nation": table(n_nationkey="int", n_name="text", n_regionkey="int"),
    "customer": table(c_custkey="long", c_name="text", c_nationkey="int", c_acctbal="double", c_mktsegment="text"),
    "supplier": table(s_suppkey="long", s_name="text", s_nationkey="int", s_acctbal="double"),
    "part": table(
        p_partkey="long", p_name="text", p_brand="text", p_type="text", p_size="int", p_retailprice="double"
    ),
    "orders": table(
        o_orderkey="long", o_custkey="long", o_orderstatus="text", o_totalprice="double", o_orderdate="moment",
        o_orderpriority="text",
    ),
    "lineitem": table(
        l_orderkey="long", l_partkey="long", l_suppkey="long", l_linenumber="int", l_quantity="double",
        l_extendedprice="double", l_discount="double", l_tax="double", l_returnflag="text", l_linestatus="text",
        l_shipdate="moment",
    ),
    "events": table(event_id="long", ts="moment", user_id="long", event_type="text", value="double", props="text"),
    "benchmark": table(item_id="long", text="text"),
    "conversations": table(conv_id="long", turn="long", role="text", text="text"),
}
