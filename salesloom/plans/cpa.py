"""Segments of the CPA channel from attributed purchases."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesloom import fixed_values as fv
from salesloom.functions.numbers import long_sum, money_sum
from salesloom.functions.rules import first_match
from salesloom.plans.attribution import any_of

_KEYS = ("date", "traffic_type", "chanel", "utm_campaign", "utm_source", "campaign_id", "os", "campaign")
_AMOUNTS = ("revenue", "completed_revenue", "sum_vozvrata", "gmv_new", "revenue_ecomm_new")
_COUNTS = (
    "installs", "purchases", "completed_purchases", "aty_sku_zakaza", "aty_sku_oplaty", "customer_is_new",
    "purchases_new",
)


def _has(column: str, text: str) -> Column:
    return F.coalesce(F.col(column).contains(text), F.lit(False))


def source_rules(networks: dict[str, bool] = fv.CPA_NETWORKS) -> list[tuple[Column, Column | str]]:
    """Ordered rules for the source name.

    A network is known by ``source=<name>`` in the parameters and, where its flag says so,
    by its name in the tracker; a deeplink adds ``_w2a``. The unknown advertising engine is
    tested after the networks with trackers and before the others.
    """
    suffix = F.when(F.coalesce(F.col("flag"), F.lit("")) != "", F.lit("_w2a")).otherwise(F.lit(""))

    def rule(name: str) -> tuple[Column, Column]:
        match = _has("parameter", f"source={name}")
        if networks[name]:
            match = match | F.coalesce(F.lower("tracker").contains(name), F.lit(False))
        return match, F.concat(F.lit(name), suffix)

    unknown = (_has("partner", fv.CPA_UNKNOWN_PARTNER), fv.CPA_UNKNOWN_SOURCE)
    by_tracker = [rule(name) for name, tracked in networks.items() if tracked]
    by_parameter = [rule(name) for name, tracked in networks.items() if not tracked]
    return [*by_tracker, unknown, *by_parameter]


def is_cpa(networks: dict[str, bool] = fv.CPA_NETWORKS) -> Column:
    """Rows of the channel: a known partner, the unknown engine with CPA marks, or a network."""
    partners = any_of([_has("partner", name) for name in fv.CPA_PARTNERS])
    marks = [_has("parameter", text) for text in fv.CPA_UNKNOWN_PARAMETERS]
    unknown = _has("partner", fv.CPA_UNKNOWN_PARTNER)
    for mark in marks:
        unknown = unknown & mark
    return partners | unknown | any_of([_has("parameter", f"source={name}") for name in networks])


def cpa_segments(
    attributed: DataFrame,
    window_days: int = fv.ATTRIBUTION_WINDOW_DAYS,
    bypass_flag: str = fv.CPA_BYPASS_FLAG,
    networks: dict[str, bool] = fv.CPA_NETWORKS,
) -> DataFrame:
    """Daily sums per campaign and source.

    A row counts inside the window after its install, or with the bypass flag. A row whose
    distance to the install is unknown needs the flag; a purchase before the install counts.
    """
    bypass = F.coalesce(F.col("flag"), F.lit("")) == bypass_flag
    in_window = F.coalesce(F.col("day_diff") <= window_days, F.lit(False))
    rows = attributed.filter(is_cpa(networks) & (in_window | bypass))
    keyed = rows.select(
        F.to_date("event_time").alias("date"),
        F.lit(fv.CPA_TRAFFIC_TYPE).alias("traffic_type"),
        F.lit(fv.CPA_CHANNEL).alias("chanel"),
        F.col("tracker").alias("utm_campaign"),
        first_match(source_rules(networks)).alias("utm_source"),
        F.lit("").alias("campaign_id"),
        first_match([(F.col("os") == name, label) for name, label in fv.CPA_OS.items()]).alias("os"),
        F.lit(fv.CPA_CAMPAIGN).alias("campaign"),
        "appmetrica_device_id",
        *_COUNTS,
        *_AMOUNTS,
    )
    return keyed.groupBy(*_KEYS).agg(
        F.lit(0).cast("bigint").alias("impressions"),
        F.lit(0).cast("bigint").alias("clicks"),
        *[long_sum(c).alias(c) for c in _COUNTS],
        *[money_sum(c).alias(c) for c in _AMOUNTS],
        F.count_distinct("appmetrica_device_id").alias("users"),
    )
