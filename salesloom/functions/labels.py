"""Numbers and dates as report text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from salesloom import fixed_values as fv


def _col(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def number_label(value, digits: int = 0) -> Column:
    """Thousands separated by spaces."""
    return F.translate(F.format_number(_col(value).cast("double"), digits), ",", " ")


def plain_label(value, digits: int) -> Column:
    """A number without a thousands separator."""
    return F.replace(F.format_number(_col(value).cast("double"), digits), F.lit(","), F.lit(""))


def money_label(value) -> Column:
    return F.concat(number_label(value), F.lit(" ₽"))


def percent_label(value) -> Column:
    return F.concat(plain_label(value, 2), F.lit("%"))


def times_label(value) -> Column:
    return F.concat(plain_label(value, 2), F.lit("x"))


def delta_label(current, previous, delta) -> Column:
    """``0%``, ``+100%`` or the change with one digit and a plus sign when it is positive."""
    current, previous, delta = _col(current), _col(previous), _col(delta)
    changed = F.concat(F.when(delta > 0, F.lit("+")).otherwise(F.lit("")), plain_label(delta, 1), F.lit("%"))
    return (
        F.when((previous == 0) & (current == 0), F.lit("0%"))
        .when(previous == 0, F.lit("+100%"))
        .otherwise(changed)
    )


def timestamp_label(value) -> Column:
    return F.coalesce(F.date_format(_col(value), "dd.MM.yyyy HH:mm"), F.lit(fv.NO_DATE))


def date_label(value) -> Column:
    return F.date_format(_col(value), "dd.MM.yyyy")
