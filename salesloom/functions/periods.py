"""Calendar expressions. Every clock value is an argument; nothing reads today's date."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

GRAINS = ("year", "quarter", "month", "week", "day")


def _col(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def as_date(value) -> dt.date:
    return value if isinstance(value, dt.date) else dt.date.fromisoformat(value)


def date_lit(value) -> Column:
    return F.lit(as_date(value))


def moment_lit(value) -> Column:
    """A timestamp without time zone, so it compares with stored values as it is."""
    text = value if isinstance(value, str) else value.isoformat(sep=" ")
    return F.lit(text).cast("timestamp_ntz")


def day_start(value) -> Column:
    return date_lit(value).cast("timestamp_ntz")


def day_end(value) -> Column:
    """The last second of the day."""
    return day_start(value) + F.expr("INTERVAL '1' DAY") - F.expr("INTERVAL '1' SECOND")


def midnights_between(start, end) -> Column:
    """Calendar days from ``start`` to ``end`` (23:00 to 01:00 next day is 1)."""
    return F.datediff(F.to_date(_col(end)), F.to_date(_col(start)))


def month_label(value) -> Column:
    return F.date_format(_col(value), "yyyy-MM")


def iso_week_label(value) -> Column:
    value = _col(value)
    year = F.extract(F.lit("YEAROFWEEK"), value).cast("string")
    return F.concat(year, F.lit("-W"), F.lpad(F.weekofyear(value).cast("string"), 2, "0"))


def weekday_name(value) -> Column:
    return F.date_format(_col(value), "EEEE")


def period_start(value, grain: str) -> Column:
    """First day of the year, quarter, month, ISO week or day."""
    if grain not in GRAINS:
        raise ValueError(f"grain must be one of {GRAINS}")
    return F.trunc(_col(value), grain) if grain != "day" else F.to_date(_col(value))
