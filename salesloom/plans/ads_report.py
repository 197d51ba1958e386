"""Daily ads report: KPIs against the previous day, breakdowns, risky campaigns, alerts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesloom import fixed_values as fv
from salesloom.functions import labels
from salesloom.functions.numbers import count_when, delta_pct, long_sum, money_sum, ratio, rounded, sum_if
from salesloom.functions.periods import as_date, date_lit
from salesloom.functions.rules import alert_rows
from salesloom.operators.kpis import day_over_day

_AMOUNTS = ("cost", "revenue")
_COUNTS = ("impressions", "clicks", "leads", "orders")


def _two_days(df: DataFrame, report_date, column: str) -> DataFrame:
    day = as_date(report_date)
    return df.filter(F.col(column).isin(day, day - dt.timedelta(days=1)))


def _sums() -> list[Column]:
    return [long_sum(c).alias(c) for c in _COUNTS] + [money_sum(c).alias(c) for c in _AMOUNTS]


def with_ratios(df: DataFrame) -> DataFrame:
    """CTR, CPC, CPL, CPA, conversion rates and ROAS; 0 where the denominator is 0."""
    return df.withColumns(
        {
            "ctr": ratio("clicks", "impressions", digits=4, on_zero=0, times=100.0),
            "cpc": ratio("cost", "clicks", digits=4, on_zero=0),
            "cpl": ratio("cost", "leads", digits=4, on_zero=0),
            "cpa": ratio("cost", "orders", digits=4, on_zero=0),
            "lead_cr": ratio("leads", "clicks", digits=4, on_zero=0, times=100.0),
            "order_cr": ratio("orders", "leads", digits=4, on_zero=0, times=100.0),
            "roas": ratio("revenue", "cost", digits=4, on_zero=0),
        }
    )


def breakdown(ads: DataFrame, report_date, keys: list[str]) -> DataFrame:
    """Sums and ratios of one day by the given keys, the most expensive first."""
    day = ads.filter(F.col("date") == date_lit(report_date)).dropna(subset=keys)
    return with_ratios(day.groupBy(*keys).agg(*_sums())).orderBy(F.col("cost").desc(), *keys)


def by_source(ads: DataFrame, report_date) -> DataFrame:
    return breakdown(ads, report_date, ["source"])


def by_campaign(ads: DataFrame, report_date) -> DataFrame:
    return breakdown(ads, report_date, ["source", "campaign"])


def is_risky(target_cpa: float, min_roas: float, min_cost: float) -> Column:
    """Spends without orders, or pays too much per order, or earns too little."""
    costly = F.col("cost") >= min_cost
    no_orders = (F.col("orders") == 0) & costly
    dear = (F.col("orders") > 0) & (F.col("cost") > F.col("orders") * F.lit(float(target_cpa)))
    weak = (F.col("revenue") < F.col("cost") * F.lit(float(min_roas))) & costly
    return no_orders | dear | weak


def bad_campaigns(
    ads: DataFrame,
    report_date,
    target_cpa: float = fv.TARGET_CPA,
    min_roas: float = fv.MIN_ROAS,
    min_cost: float = fv.BAD_CAMPAIGN_COST,
) -> DataFrame:
    risky = by_campaign(ads, report_date).filter(is_risky(target_cpa, min_roas, min_cost))
    return risky.orderBy(F.col("cost").desc(), F.col("cpa").desc(), "source", "campaign")


def top_campaigns(ads: DataFrame, report_date, k: int = 8) -> DataFrame:
    return by_campaign(ads, report_date).orderBy(F.col("cost").desc(), "source", "campaign").limit(k)


def _day_row(
    ads: DataFrame,
    report_date,
    target_cpa: float = fv.TARGET_CPA,
    min_roas: float = fv.MIN_ROAS,
    min_cost: float = fv.BAD_CAMPAIGN_COST,
) -> DataFrame:
    """One row with the totals of both days and the number of risky campaigns.

    The two days are summed per campaign first; the last step sees campaigns, not events.
    """
    campaigns = _two_days(ads, report_date, "date").groupBy("date", "source", "campaign").agg(*_sums())
    today = F.col("date") == date_lit(report_date)
    totals = []
    for prefix, on_day in (("cur", today), ("prev", ~today)):
        totals += [sum_if(c, on_day).alias(f"{prefix}_{c}") for c in _AMOUNTS]
        totals += [long_sum(F.when(on_day, F.col(c))).alias(f"{prefix}_{c}") for c in _COUNTS]
    known = F.col("source").isNotNull() & F.col("campaign").isNotNull()
    risky = count_when(today & known & is_risky(target_cpa, min_roas, min_cost)).alias("bad_campaigns")
    row = campaigns.agg(*totals, risky)
    for prefix in ("cur", "prev"):
        row = row.withColumns(
            {
                f"{prefix}_cpl": ratio(f"{prefix}_cost", f"{prefix}_leads", on_zero=0),
                f"{prefix}_cpa": ratio(f"{prefix}_cost", f"{prefix}_orders", on_zero=0),
                f"{prefix}_roas": ratio(f"{prefix}_revenue", f"{prefix}_cost", on_zero=0),
            }
        )
    return row


# KPI -> (source column, does a higher value count as good)
_KPIS = {
    "spend": ("cost", False),
    "leads": ("leads", True),
    "cpl": ("cpl", False),
    "cpa": ("cpa", False),
    "roas": ("roas", True),
    "revenue": ("revenue", True),
}


def _kpi_rows(ads: DataFrame, report_date) -> DataFrame:
    spec = {
        key: (F.lit(fv.AD_KPI_TITLES[key]), F.col(f"cur_{column}"), F.col(f"prev_{column}"), better)
        for key, (column, better) in _KPIS.items()
    }
    return day_over_day(_day_row(ads, report_date), spec)


def daily_kpis(ads: DataFrame, report_date) -> DataFrame:
    return _kpi_rows(ads, report_date).select(
        "position",
        "kpi",
        rounded("value", 4).alias("value"),
        rounded("prev_value", 4).alias("prev_value"),
        rounded("delta_pct", 4).alias("delta_pct"),
        "is_good",
    )


def kpi_labels(ads: DataFrame, report_date) -> DataFrame:
    """The KPI lines of the message: title, value and signed change as text."""
    value = F.col("value")
    text = (
        F.when(F.col("kpi") == "leads", labels.number_label(value))
        .when(F.col("kpi") == "roas", labels.times_label(value))
        .otherwise(labels.money_label(value))
    )
    change = labels.delta_label("value", "prev_value", "delta_pct")
    rows = _kpi_rows(ads, report_date).select("position", "title", text.alias("label"), change.alias("delta_label"))
    line = F.format_string("%s: %s (%s к прошлому дню)", "title", "label", "delta_label")
    return rows.withColumn("message_line", line)


def ad_alerts(
    ads: DataFrame,
    report_date,
    target_cpa: float = fv.TARGET_CPA,
    min_roas: float = fv.MIN_ROAS,
    min_cost: float = fv.BAD_CAMPAIGN_COST,
) -> DataFrame:
    row = _day_row(ads, report_date, target_cpa, min_roas, min_cost)

    def change(name: str) -> Column:
        return delta_pct(f"cur_{name}", f"prev_{name}")

    text = {code: F.lit(message) for code, message in fv.AD_ALERTS.items()}
    rules = [
        ("leads_down", change("leads") <= -15, text["leads_down"]),
        ("cpl_up", change("cpl") >= 20, text["cpl_up"]),
        ("cpa_up", change("cpa") >= 20, text["cpa_up"]),
        ("roas_low", F.col("cur_roas") < min_roas, F.format_string(fv.AD_ALERTS["roas_low"], F.lit(float(min_roas)))),
        ("roas_down", change("roas") <= -20, text["roas_down"]),
        (
            "bad_campaigns",
            F.col("bad_campaigns") > 0,
            F.format_string(fv.AD_ALERTS["bad_campaigns"], F.col("bad_campaigns")),
        ),
    ]
    return alert_rows(row, rules, fv.AD_ALERTS["none"])


def events_mart(events: DataFrame, report_date) -> DataFrame:
    """Campaign table of both days from single events; ratios are NULL on a zero denominator."""
    lead = F.col("event_name") == "lead"
    purchase = F.col("event_name") == "purchase"
    grouped = (
        _two_days(events, report_date, "stat_date")
        .groupBy(F.col("stat_date").alias("report_date"), "source", "campaign")
        .agg(
            long_sum("impressions").alias("impressions"),
            long_sum("clicks").alias("clicks"),
            money_sum("cost").alias("cost"),
            count_when(lead).alias("leads"),
            count_when(purchase).alias("orders"),
            sum_if("revenue", purchase).alias("revenue"),
        )
    )
    return grouped.withColumns(
        {
            "ctr": ratio("clicks", "impressions", digits=2, times=100.0),
            "cpc": ratio("cost", "clicks", digits=2),
            "cpl": ratio("cost", "leads", digits=2),
            "cpa": ratio("cost", "orders", digits=2),
            "roas": ratio("revenue", "cost", digits=2),
        }
    ).orderBy("report_date", F.col("cost").desc(), "source", "campaign")
