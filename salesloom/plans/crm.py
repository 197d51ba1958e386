"""CRM control: overdue, stale and unassigned requests."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesloom import fixed_values as fv
from salesloom.functions.labels import number_label
from salesloom.functions.numbers import count_when, money_sum, sum_if
from salesloom.functions.periods import as_date, date_lit, day_end, day_start, midnights_between
from salesloom.functions.rules import alert_rows, first_match, joined_reasons
from salesloom.functions.text import or_label
from salesloom.operators.kpis import to_long

FLAGS = (
    "is_open", "is_new_today", "is_overdue_action", "is_overdue_close", "is_without_manager", "is_stale",
    "is_high_priority", "is_large_amount", "is_hot_overdue",
)


def _sure(condition: Column) -> Column:
    """A condition that is false where it is unknown."""
    return F.coalesce(condition, F.lit(False))


def _in(column: str, values: Sequence[str]) -> Column:
    return _sure(F.col(column).isin(*values))


def _stale_before(report_date, stale_days: int) -> Column:
    return day_start(as_date(report_date) - dt.timedelta(days=stale_days))


def crm_flags(
    requests: DataFrame,
    report_date,
    stale_days: int = fv.CRM_STALE_DAYS,
    closed: Sequence[str] = fv.CRM_CLOSED_STATUSES,
    high: Sequence[str] = fv.CRM_HIGH_PRIORITY,
) -> DataFrame:
    """Requests with their flags, days without an update and the risk score."""
    end = day_end(report_date)
    is_open = ~_in("status", closed)
    df = requests.withColumn("manager", F.coalesce(F.trim("manager"), F.lit("")))
    df = df.withColumns(
        {
            "is_open": is_open,
            "is_new_today": _sure(F.to_date("created_at") == date_lit(report_date)),
            "is_overdue_action": is_open & _sure(F.col("next_action_due_at") <= end),
            "is_overdue_close": is_open & _sure(F.col("close_due_at") <= end),
            "is_without_manager": is_open & (F.col("manager") == ""),
            "is_stale": is_open & _sure(F.col("status_updated_at") < _stale_before(report_date, stale_days)),
            "is_high_priority": _in("priority", high),
            "is_large_amount": _sure(F.col("amount") >= fv.CRM_LARGE_AMOUNT),
        }
    )
    idle = midnights_between("status_updated_at", date_lit(report_date))
    score = sum((F.col(flag).cast("int") * weight for flag, weight in fv.CRM_RISK_WEIGHTS.items()), F.lit(0))
    return df.withColumns(
        {
            "is_hot_overdue": F.col("is_high_priority") & F.col("is_overdue_action"),
            "days_without_update": F.when(idle.isNotNull(), F.greatest(idle, F.lit(0))),
            "risk_score": score,
        }
    )


def _is_problem() -> Column:
    return (
        F.col("is_overdue_action") | F.col("is_overdue_close") | F.col("is_without_manager") | F.col("is_stale")
    )


def problem_cases(flagged: DataFrame) -> DataFrame:
    """Requests with a problem and the reasons as text, the riskiest first."""
    return (
        flagged.filter(_is_problem())
        .select(
            "request_id",
            "client",
            "source",
            or_label("manager", fv.NO_MANAGER).alias("manager"),
            "status",
            "priority",
            "amount",
            "next_action_due_at",
            "close_due_at",
            "days_without_update",
            "risk_score",
            joined_reasons(fv.CRM_REASONS).alias("problem"),
        )
        .orderBy(
            F.col("risk_score").desc(),
            F.col("amount").desc_nulls_last(),
            F.col("next_action_due_at").asc_nulls_last(),
            "request_id",
        )
    )


def _metrics_row(flagged: DataFrame) -> DataFrame:
    overdue = F.col("is_overdue_action") | F.col("is_overdue_close")
    return flagged.agg(
        count_when(F.col("is_open")).alias("total_open"),
        count_when(F.col("is_new_today")).alias("new_today"),
        count_when(F.col("is_overdue_action")).alias("overdue_action"),
        count_when(F.col("is_overdue_close")).alias("overdue_close"),
        count_when(F.col("is_without_manager")).alias("without_manager"),
        count_when(F.col("is_stale")).alias("stale"),
        count_when(F.col("is_hot_overdue")).alias("hot_overdue"),
        count_when(_is_problem()).alias("problem_cases"),
        F.floor(sum_if("amount", overdue)).cast("bigint").alias("risk_amount"),
    )


def crm_metrics(flagged: DataFrame) -> DataFrame:
    """The headline counts as ``(metric, value)`` rows; ``risk_amount`` in whole units."""
    row = _metrics_row(flagged)
    return to_long(row, row.columns, cast="bigint")


def by_manager(flagged: DataFrame) -> DataFrame:
    """Open requests by manager. ``risk_amount`` is the amount of all of them."""
    grouped = (
        flagged.filter("is_open")
        .groupBy(or_label("manager", fv.NO_MANAGER).alias("manager"))
        .agg(
            F.count("request_id").alias("open_requests"),
            count_when(F.col("is_overdue_action")).alias("overdue_action"),
            count_when(F.col("is_overdue_close")).alias("overdue_close"),
            count_when(F.col("is_stale")).alias("stale"),
            money_sum("amount").alias("risk_amount"),
        )
    )
    return grouped.orderBy(
        F.col("overdue_action").desc(), F.col("overdue_close").desc(), F.col("risk_amount").desc(), "manager"
    )


def by_manager_created(flagged: DataFrame, report_date) -> DataFrame:
    """By manager over requests created up to the report date, closed ones included.

    ``amount_in_risk`` holds only requests that are overdue or stale, a third meaning of
    "amount" next to ``risk_amount`` of the metrics and of ``by_manager``.
    """
    at_risk = F.col("is_overdue_action") | F.col("is_overdue_close") | F.col("is_stale")
    grouped = (
        flagged.filter(F.col("created_at") <= day_end(report_date))
        .groupBy("manager")
        .agg(
            count_when(F.col("is_open")).alias("open_requests"),
            count_when(F.col("is_overdue_action")).alias("overdue_actions"),
            count_when(F.col("is_overdue_close")).alias("overdue_closings"),
            count_when(F.col("is_without_manager")).alias("without_manager"),
            count_when(F.col("is_stale")).alias("stale_requests"),
            sum_if("amount", at_risk).alias("amount_in_risk"),
        )
    )
    return grouped.orderBy(
        F.col("overdue_actions").desc(), F.col("overdue_closings").desc(), F.col("amount_in_risk").desc(), "manager"
    )


def problem_detail(flagged: DataFrame, report_date, hot: Sequence[str] = fv.CRM_HOT_PRIORITY) -> DataFrame:
    """Problem requests with the first matching problem; days without update may be negative."""
    is_hot = _in("priority", hot)
    problem = first_match(
        [
            (F.col("is_overdue_action") & is_hot, fv.CRM_PROBLEMS["hot_action"]),
            (F.col("is_overdue_action"), fv.CRM_PROBLEMS["action"]),
            (F.col("is_overdue_close"), fv.CRM_PROBLEMS["close"]),
            (F.col("is_without_manager"), fv.CRM_PROBLEMS["no_manager"]),
            (F.col("is_stale"), fv.CRM_PROBLEMS["stale"]),
        ],
        otherwise=fv.CRM_PROBLEMS["other"],
    )
    return (
        flagged.filter(_is_problem())
        .select(
            "request_id",
            "client",
            "source",
            or_label("manager", fv.NO_MANAGER).alias("manager"),
            "status",
            "priority",
            "amount",
            "next_action_due_at",
            "close_due_at",
            midnights_between("status_updated_at", date_lit(report_date)).alias("days_without_update"),
            problem.alias("problem"),
        )
        .orderBy(
            _in("priority", hot).desc(),
            F.col("amount").desc_nulls_last(),
            F.col("next_action_due_at").asc_nulls_last(),
            "request_id",
        )
    )


def top_cases(cases: DataFrame, k: int = 12) -> DataFrame:
    return cases.orderBy(
        F.col("risk_score").desc(),
        F.col("amount").desc_nulls_last(),
        F.col("next_action_due_at").asc_nulls_last(),
        "request_id",
    ).limit(k)


def overdue_trend(flagged: DataFrame, report_date, days: int = 7) -> DataFrame:
    """Requests overdue at the end of each of the last ``days`` days.

    Today's open status stands for the past days too, as there is no status history. A
    request counts from the later of its creation and due day on, so one pass with a count
    per day gives all days, without a join of days and requests.
    """
    since = F.greatest(F.to_date("created_at"), F.to_date("next_action_due_at"))
    known = F.col("is_open") & F.col("created_at").isNotNull() & F.col("next_action_due_at").isNotNull()
    last = as_date(report_date)
    dates = [last - dt.timedelta(days=back) for back in range(days - 1, -1, -1)]
    counts = flagged.agg(*[count_when(known & (since <= F.lit(d))).alias(f"d{i}") for i, d in enumerate(dates)])
    rows = [F.struct(F.lit(d).alias("date"), F.col(f"d{i}").alias("overdue")) for i, d in enumerate(dates)]
    return counts.select(F.inline(F.array(*rows)))


def crm_alerts(flagged: DataFrame) -> DataFrame:
    row = _metrics_row(flagged)
    rules = []
    for code in ("hot_overdue", "without_manager", "stale", "risk_amount"):
        shown = number_label(code) if code == "risk_amount" else F.col(code)
        rules.append((code, F.col(code) > 0, F.format_string(fv.CRM_ALERTS[code], shown)))
    return alert_rows(row, rules, fv.CRM_ALERTS["none"])


__all__ = [
    "by_manager", "by_manager_created", "crm_alerts", "crm_flags", "crm_metrics", "overdue_trend",
    "problem_cases", "problem_detail", "top_cases",
]
