"""Exact distinct counts as bitmaps: mergeable states that combine before the shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesloom.operators.ranking import sequential_ids


def _col(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def bucket_of(number) -> Column:
    """Which bitmap a whole number belongs to: group by this beside the report's own keys."""
    return F.shiftright(_col(number).cast("bigint"), 6)


def bits_of(number) -> Column:
    """Aggregate: the numbers of a group and bucket as a bitmap of 64 bits. NULL is left out.

    A bitmap takes no more room than a number does. So a group with few of the numbers has no more than
    a row for each, however many numbers there are, and one with many of them a row for 64.
    """
    place = _col(number).cast("bigint").bitwiseAND(F.lit(63)).cast("int")
    return F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), place))


def merged_bits(bits) -> Column:
    """Aggregate: bitmaps of the same bucket, from several loads, as one."""
    return F.bit_or(_col(bits))


def counted_bits(bits) -> Column:
    """Aggregate over the buckets of a group: how many different numbers."""
    return F.coalesce(F.sum(F.bit_count(_col(bits))), F.lit(0)).cast("bigint")


def dense_numbers(df: DataFrame, column: str, name: str) -> DataFrame:
    """``column`` and its number ``name``, 1, 2, 3, ...: ids that are texts have no place in a bitmap, those far apart one each."""
    ids = df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias(column)).agg(F.first(F.col(column).cast("string")).alias("_text"))
    return sequential_ids(ids, "_text", name).drop("_text")
