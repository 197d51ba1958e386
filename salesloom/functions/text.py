"""Cleaning of names, phones, emails and free text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from salesloom import fixed_values as fv


def _col(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def blank_to_null(value) -> Column:
    trimmed = F.trim(_col(value))
    return F.when(trimmed != "", trimmed)


def or_label(value, label: str) -> Column:
    """The trimmed value, or ``label`` when it is missing or blank."""
    return F.coalesce(blank_to_null(value), F.lit(label))


def title_case(value) -> Column:
    """Capital after every non-letter ("санкт-петербург" becomes "Санкт-Петербург")."""
    runs = F.regexp_extract_all(_col(value), F.lit(r"\p{L}+|[^\p{L}]+"), F.lit(0))
    return F.concat_ws("", F.transform(runs, F.initcap))


def single_spaced(value) -> Column:
    return F.trim(F.regexp_replace(_col(value), r"(?U)\s+", " "))


def digits_only(value) -> Column:
    return F.regexp_replace(_col(value), r"\D+", "")


def normalize_phone(value) -> Column:
    """Russian number as ``+7XXXXXXXXXX``; empty when it is missing or has another form."""
    digits = digits_only(value)
    national = (
        F.when(F.length(digits) == 10, digits)
        .when((F.length(digits) == 11) & F.substring(digits, 1, 1).isin("7", "8"), F.substring(digits, 2, 10))
    )
    return F.coalesce(F.concat(F.lit("+7"), national), F.lit(""))


def normalize_email(value, pattern: str = fv.EMAIL_PATTERN) -> Column:
    """Lower case without spaces; empty when it does not look like an address."""
    email = F.lower(F.regexp_replace(_col(value), r"(?U)\s+", ""))
    return F.when(email.rlike(pattern), email).otherwise(F.lit(""))


def normalize_name(value) -> Column:
    return F.coalesce(title_case(single_spaced(F.translate(_col(value), "ёЁ", "еЕ"))), F.lit(""))


def normalize_city(value) -> Column:
    return F.coalesce(title_case(single_spaced(value)), F.lit(""))


def word_set(value, pattern: str = fv.FAQ_TOKEN_PATTERN, stop_words: Sequence[str] = fv.FAQ_STOP_WORDS) -> Column:
    """Distinct lower-case words of a text without stop words."""
    text = F.translate(F.lower(F.coalesce(_col(value), F.lit(""))), "ё", "е")
    words = F.array_distinct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))
    if not stop_words:
        return words
    return F.array_except(words, F.array(*[F.lit(w) for w in stop_words]))


def filled_count(columns: Sequence[str], nan_counts_as_filled: Sequence[str] = ()) -> Column:
    """How many of the columns hold a value.

    A column named in ``nan_counts_as_filled`` counts as filled when it is NULL, as it
    does when missing values are turned into the text "nan" before the test.
    """
    total = F.lit(0)
    for name in columns:
        text = F.trim(F.col(name).cast("string"))
        filled = F.coalesce(text != "", F.lit(name in nan_counts_as_filled))
        total = total + filled.cast("int")
    return total
