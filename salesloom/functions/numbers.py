"""Ratios, deltas, rounding and exact sums.

Amounts are doubles, as in the files they come from. Rounding scales, rounds half to even
and scales back, which is what array libraries and column stores do with doubles, and costs
a few instructions per row. Sums are taken over whole ten-thousandths, so they do not depend
on the order in which tasks finish.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNITS = 10_000  # parts of one unit of money that sums keep


def _col(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def rounded(value, digits: int) -> Column:
    """A double with ``digits`` decimals."""
    scale = F.lit(float(10**digits))
    return F.rint(_col(value).cast("double") * scale) / scale


def money(value) -> Column:
    """Whole ten-thousandths of an amount, ready for an exact sum."""
    return F.rint(_col(value).cast("double") * F.lit(float(UNITS))).cast("bigint").cast("decimal(18,0)")


def from_units(total, digits: int = 2) -> Column:
    """A sum of ``money`` back as a double."""
    return rounded(_col(total).cast("double") / F.lit(float(UNITS)), digits)


def money_sum(value, digits: int = 2) -> Column:
    """Exact sum of an amount; 0 for a group without a value."""
    return F.coalesce(from_units(F.sum(money(value)), digits), F.lit(0.0))


def sum_if(value, condition: Column, digits: int = 2) -> Column:
    return money_sum(F.when(condition, _col(value)), digits)


def count_when(condition: Column) -> Column:
    """Rows where ``condition`` is true, as a bigint (0 when there are none)."""
    return F.count(F.when(condition, F.lit(1)))


def long_sum(value) -> Column:
    return F.coalesce(F.sum(_col(value).cast("bigint")), F.lit(0)).cast("bigint")


def ratio(num, den, digits: int | None = None, on_zero=None, times: float = 1.0) -> Column:
    """``num / den``. A zero or missing denominator gives ``on_zero`` (None or a number)."""
    value = F.try_divide(_col(num).cast("double"), _col(den).cast("double"))
    if times != 1.0:
        value = value * F.lit(times)
    if digits is not None:
        value = rounded(value, digits)
    if on_zero is not None:
        value = F.coalesce(value, F.lit(float(on_zero)))
    return value


def delta_pct(current, previous, digits: int | None = None) -> Column:
    """Change in percent: 0 when both are 0, +100 when only the previous value is 0."""
    current, previous = _col(current).cast("double"), _col(previous).cast("double")
    change = (
        F.when((previous == 0) & (current == 0), F.lit(0.0))
        .when(previous == 0, F.lit(100.0))
        .otherwise(F.try_divide(current - previous, previous) * F.lit(100.0))
    )
    return change if digits is None else rounded(change, digits)


def is_good(delta, higher_is_better: Column) -> Column:
    """No change is good; otherwise the sign has to match the direction of the metric."""
    delta = _col(delta)
    return (delta == 0) | F.when(higher_is_better, delta > 0).otherwise(delta < 0)
