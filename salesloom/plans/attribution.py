"""Attribution of app purchases to installs and deeplinks.

Tables joined on the order id: a third of the purchases may carry one id (a blank one, say),
and several joins on it follow each other. The purchases get a salt once, from a count of
their ids, and the lookups repeat only the rows of hot ids, so all these joins stay even.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesloom import fixed_values as fv
from salesloom.functions.periods import as_date, midnights_between
from salesloom.operators.joins import ROWS_PER_TASK, hot_keys, spread_join
from salesloom.operators.ranking import number_in_group

_CRM_METRICS = (
    "revenue", "completed_purchases", "completed_revenue", "sum_vozvrata", "aty_sku_zakaza", "aty_sku_oplaty",
    "customer_is_new", "gmv_new", "revenue_ecomm_new", "purchases_new",
)
COLUMNS = (
    "install_time", "event_time", "installation_id", "appmetrica_device_id", "buyer", "partner", "tracker",
    "parameter", "os", "ecom_order_id", *_CRM_METRICS, "purchases", "installs", "day_diff", "flag",
)


def known_orders(crm: DataFrame, purchases: DataFrame) -> DataFrame:
    """CRM orders that occur among the purchases; the ids are combined before the shuffle, hot ones to one each."""
    ids = purchases.select(F.col("ecom_order_id").alias("increment_id")).distinct()
    return crm.join(ids, "increment_id", "left_semi")


def clean_installs(installs: DataFrame) -> DataFrame:
    return installs.select(
        F.col("install_datetime").alias("install_time"),
        "installation_id",
        "appmetrica_device_id",
        F.col("publisher_name").alias("partner"),
        F.col("tracker_name").alias("tracker"),
        F.col("click_url_parameters").alias("parameter"),
        F.col("os_name").alias("os"),
    ).distinct()


def clean_purchases(purchases: DataFrame, both_orders: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """Distinct purchases without the orders that belong to the web.

    An order stays when it is not in the lookup, or has any other flag there.
    """
    is_web = F.coalesce(F.col("flag"), F.lit("")) == fv.WEB_FLAG
    web = (
        both_orders.groupBy(F.col("purchase_id").alias("ecom_order_id"))
        .agg(F.min(is_web).alias("_only_web"))
        .filter("_only_web")
        .select("ecom_order_id")
    )
    events = purchases.select(
        F.col("event_datetime").alias("event_time"),
        "installation_id",
        F.col("appmetrica_device_id").alias("buyer"),
        "ecom_order_id",
    ).distinct()
    hot = hot_keys(purchases, "ecom_order_id") if hot is None else hot
    return spread_join(events, web, "ecom_order_id", "left_anti", hot=hot)


def _period(moment: Column, match: str) -> Column:
    """Month number as matched by default; ``year_month`` tells the years apart."""
    if match not in ("month", "year_month"):
        raise ValueError("match must be 'month' or 'year_month'")
    return F.month(moment) if match == "month" else F.year(moment) * 100 + F.month(moment)


def crm_metrics(crm: DataFrame, match: str = "month") -> DataFrame:
    """CRM columns as they enter the dataset, one row per distinct order, period and values.

    Distinct here means that the join with distinct purchases needs no second distinct.
    """
    complete = F.col("status").contains("compl")
    new = F.col("customer_is_new") == 1
    created = F.col("created_at_msk") + F.expr("INTERVAL '3' HOUR")
    return crm.select(
        F.col("increment_id").alias("ecom_order_id"),
        _period(created, match).alias("_period"),
        F.col("sum_zakaza").cast("double").alias("revenue"),
        F.when(complete, 1).alias("completed_purchases"),
        F.col("sum_oplaty").cast("double").alias("completed_revenue"),
        F.col("sum_vozvrata").cast("double").alias("sum_vozvrata"),
        F.col("aty_sku_zakaza").cast("int").alias("aty_sku_zakaza"),
        F.col("aty_sku_oplaty").cast("int").alias("aty_sku_oplaty"),
        F.when(new, 1).alias("customer_is_new"),
        F.when(new, F.col("sum_zakaza")).cast("double").alias("gmv_new"),
        F.when(new & complete, F.col("sum_oplaty")).cast("double").alias("revenue_ecomm_new"),
        F.when(new & F.col("sum_oplaty").isNotNull(), 1).alias("purchases_new"),
    ).distinct()


def purchase_crm(
    purchases: DataFrame, crm: DataFrame, match: str = "month", hot: DataFrame | None = None
) -> DataFrame:
    """Clean purchases with the CRM values of the same order and month."""
    dated = purchases.withColumn("_period", _period(F.col("event_time"), match))
    joined = spread_join(dated, crm_metrics(crm, match), "ecom_order_id", "left", extra_on=["_period"], hot=hot)
    return joined.select(*purchases.columns, *_CRM_METRICS)


def number_orders(joined: DataFrame) -> DataFrame:
    """Number the rows of an order id by install time; rows without an install come first.

    Rows are split by hour of install, and those without one by hour of purchase, so neither
    a hot order id nor a blank one is numbered in one task.
    """
    order = [
        F.col("install_time").asc_nulls_first(),
        *[F.col(c).asc_nulls_first() for c in ("event_time", "installation_id", "buyer", "partner", "tracker", "parameter", "os")],
        *[F.col(c).asc_nulls_first() for c in _CRM_METRICS],
    ]
    # Purchases without an install sort first: their hours are moved before all installs.
    before_installs = F.date_trunc("hour", F.col("event_time")) - F.expr("INTERVAL '100000' DAY")
    hour = F.coalesce(F.date_trunc("hour", F.col("install_time")), before_installs)
    return number_in_group(joined, ["ecom_order_id"], order, "num", bucket=hour)


def deduplicate(joined: DataFrame, strict: bool = False) -> DataFrame:
    """Flag the first row of an order as the purchase and drop the second.

    Third and later rows stay without the purchase flag, as in the query this mart follows;
    ``strict`` keeps the first row only.
    """
    numbered = number_orders(joined)
    first = F.col("num") == 1
    has_install = F.col("install_time").isNotNull()
    kept = numbered.filter(first if strict else F.col("num") != 2)
    return kept.select(
        *joined.columns,
        "num",
        F.when(first, 1).alias("purchases"),
        F.when(has_install, 1).alias("installs"),
        F.when(has_install & first, midnights_between("install_time", "event_time")).alias("day_diff"),
    )


def attributed_purchases(
    installs: DataFrame,
    purchases: DataFrame,
    crm: DataFrame,
    both_orders: DataFrame,
    match: str = "month",
    hot: DataFrame | None = None,
) -> DataFrame:
    """Clean purchases with CRM values and each of their installs, before numbering.

    The CRM is reduced to the purchases' orders before its distinct rows are made. A purchase
    comes once per distinct install of its installation id; numbering by install time decides which
    of them counts.
    """
    hot = hot_keys(purchases, "ecom_order_id") if hot is None else hot
    valued = purchase_crm(clean_purchases(purchases, both_orders, hot), known_orders(crm, purchases), match, hot)
    return valued.join(clean_installs(installs), "installation_id", "left")


def attribution(
    installs: DataFrame,
    purchases: DataFrame,
    crm: DataFrame,
    both_orders: DataFrame,
    web_to_app: DataFrame,
    as_of=None,
    days: int = fv.ATTRIBUTION_LOOKBACK_DAYS,
    strict: bool = False,
    match: str = "month",
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Purchases with their source; the deeplink wins over the install.

    With ``as_of`` only purchases of the ``days`` days up to the day before remain. That
    filter comes after numbering, which looks at the whole history of an order.
    """
    hot = hot_keys(purchases, "ecom_order_id", rows_per_task)
    joined = attributed_purchases(installs, purchases, crm, both_orders, match, hot)
    numbered = deduplicate(joined, strict).drop("num")
    if as_of is not None:
        last = as_date(as_of) - dt.timedelta(days=1)
        day = F.to_date("event_time")
        numbered = numbered.filter(day.between(as_date(as_of) - dt.timedelta(days=days), last))
    links = web_to_app.select(
        F.col("order_id").alias("ecom_order_id"),
        "publisher_name",
        "tracker_name",
        "url_params",
        F.lit(fv.CPA_BYPASS_FLAG).alias("flag"),
    )
    tagged = spread_join(numbered, links, "ecom_order_id", "left", hot=hot)
    linked = F.col("flag").isNotNull()
    overrides = {"partner": "publisher_name", "tracker": "tracker_name", "parameter": "url_params"}
    return tagged.withColumns(
        {own: F.when(linked, F.col(link)).otherwise(F.col(own)) for own, link in overrides.items()}
    ).select(*COLUMNS)


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)
