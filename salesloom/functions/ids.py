"""Stable ids derived from a row's own values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def short_hash(value, length: int) -> Column:
    return F.substring(F.sha1(_col(value)), 1, length)


def row_id(prefix: str, created_at, natural_key) -> Column:
    """``L-20240131-1A2B3C4D5E6F7A8B``: prefix, day and 64 bits of the natural key's hash.

    Ids are keys of later joins, so they must stay apart for any number of rows a day.

    The key takes the place of a random number, so a task that runs again gives the same id.
    """
    day = F.date_format(_col(created_at), "yyyyMMdd")
    return F.concat(F.lit(prefix + "-"), day, F.lit("-"), F.upper(short_hash(_col(natural_key).cast("string"), 16)))
