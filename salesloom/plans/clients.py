"""Cleaning and deduplication of a client base."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesloom import fixed_values as fv
from salesloom.functions.ids import short_hash
from salesloom.functions.numbers import count_when, long_sum, rounded
from salesloom.functions.text import (
    filled_count,
    normalize_city,
    normalize_email,
    normalize_name,
    normalize_phone,
)
from salesloom.operators.joins import hot_from_counts, spread_join
from salesloom.operators.kpis import to_long
from salesloom.operators.ranking import first_filled, number_in_group, sequential_ids

CONTACTS = ("full_name", "phone", "email", "city")
_SCORED = ("full_name_clean", "phone_clean", "email_clean", "city_clean", "registered_at", "last_order_at", "loyalty_level")
_KEPT = (
    "client_id", "source", "registered_at", "last_order_at", "total_orders", "revenue_rub", "loyalty_level",
    "consent_email", "consent_sms",
)
# Ids in one part of an id list, and row numbers that are numbered together.
PART_IDS, ROW_RANGE = 100, 100_000


def normalize_contacts(clients: DataFrame) -> DataFrame:
    """Clean copies of name, phone, email and city; empty text when nothing usable is left."""
    return clients.withColumns(
        {
            "full_name_clean": normalize_name("full_name"),
            "phone_clean": normalize_phone("phone"),
            "email_clean": normalize_email("email"),
            "city_clean": normalize_city("city"),
        }
    )


def duplicate_key() -> Column:
    """Phone, else email, else a hash of name and city."""
    name_city = F.concat_ws("|", "full_name_clean", "city_clean")
    return (
        F.when(F.col("phone_clean") != "", F.concat(F.lit("phone:"), "phone_clean"))
        .when(F.col("email_clean") != "", F.concat(F.lit("email:"), "email_clean"))
        .otherwise(F.concat(F.lit("name_city:"), short_hash(name_city, 16)))
    )


def with_keys(clients: DataFrame, nan_counts_as_filled: bool = False) -> DataFrame:
    """Clean contacts, completeness score and duplicate key.

    A missing date or loyalty level counts as empty, unless ``nan_counts_as_filled``.
    """
    lenient = ("registered_at", "last_order_at", "loyalty_level") if nan_counts_as_filled else ()
    return (
        normalize_contacts(clients)
        .withColumn("completeness_score", filled_count(_SCORED, lenient))
        .withColumn("duplicate_key", duplicate_key())
    )


def _groups(keyed: DataFrame) -> DataFrame:
    """One row per duplicate key, by aggregates that combine before the shuffle.

    The master is the fullest record, then the one with the latest order, more revenue,
    more orders, and the earlier row. Contacts come from the first row that has them.
    """
    best_first = F.struct(
        "completeness_score", "last_order_at", "revenue_rub", "total_orders", (-F.col("row_no")).alias("earlier")
    )
    return keyed.groupBy("duplicate_key").agg(
        F.max_by(F.struct(*_KEPT), best_first).alias("master"),
        *[first_filled(f"{c}_clean", "row_no").alias(c) for c in CONTACTS],
        F.count(F.lit(1)).alias("records"),
        count_when(F.col("phone_clean") != "").alias("phones"),
        count_when(F.col("email_clean") != "").alias("emails"),
    )


def _id_lists(clients: DataFrame) -> DataFrame:
    """Every id of a group in row order, ``PART_IDS`` to a part; parts count from 0.

    Rows are numbered inside ranges of row numbers, and a cell holds one part, so a group of
    any size is spread over tasks and cells.
    """
    row_range = F.expr(f"row_no div {ROW_RANGE}")
    numbered = number_in_group(
        clients.select("duplicate_key", "row_no", F.col("client_id").cast("string").alias("id")),
        ["duplicate_key"],
        [F.col("row_no")],
        "position",
        bucket=row_range,
    )
    parts = numbered.withColumn("part", F.expr(f"(position - 1) div {PART_IDS}"))
    ids = F.array_sort(F.collect_list(F.struct("position", "id")))
    listed = parts.groupBy("duplicate_key", "part").agg(ids.alias("_ids"))
    return listed.select("duplicate_key", "part", F.concat_ws(", ", F.col("_ids.id")).alias("merged_client_ids"))


def client_id_list(keyed: DataFrame) -> DataFrame:
    """The raw ids merged into each client, in parts."""
    return _id_lists(keyed).select(short_hash("duplicate_key", 12).alias("client_uid"), "duplicate_key", "part", "merged_client_ids")


def client_id_list_simple(clients: DataFrame) -> DataFrame:
    """The raw ids of each group of ``duplicate_groups_simple``, in parts."""
    listed = _id_lists(_simple_keys(clients))
    groups = _simple_keys(clients).groupBy("duplicate_key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return listed.join(groups.select("duplicate_key"), "duplicate_key", "left_semi").withColumnRenamed(
        "merged_client_ids", "client_ids"
    )


def client_master(keyed: DataFrame) -> DataFrame:
    """One clean row per client; ``client_id_list`` has the ids merged into it."""
    return _groups(keyed).select(
        short_hash("duplicate_key", 12).alias("client_uid"),
        F.col("master.client_id").alias("client_id"),
        *CONTACTS,
        F.col("master.source").alias("primary_source"),
        *[F.col(f"master.{c}").alias(c) for c in _KEPT if c not in ("client_id", "source")],
        F.col("records").alias("raw_records_in_group"),
    ).orderBy(F.col("revenue_rub").desc_nulls_last(), F.col("total_orders").desc_nulls_last(), "client_uid")


def merge_map(keyed: DataFrame) -> DataFrame:
    """Every raw record with its client: the id lists in long form, for groups of any size."""
    return keyed.select(
        short_hash("duplicate_key", 12).alias("client_uid"), "duplicate_key", "row_no", "client_id"
    )


def duplicate_groups(keyed: DataFrame) -> DataFrame:
    """Groups of two or more records. Ids number all groups in key order, singles included.

    ``client_id_list`` has the ids of a group.
    """
    groups = _groups(keyed).select("duplicate_key", "records", F.col("master.client_id").alias("selected_client_id"))
    numbered = sequential_ids(groups, "duplicate_key", "duplicate_group_id").filter("records > 1")
    return numbered.select(
        "duplicate_group_id",
        "duplicate_key",
        F.col("records").alias("records_in_group"),
        "selected_client_id",
        F.lit(fv.DEDUP_REASON).alias("dedup_reason"),
    )


def _simple_keys(clients: DataFrame) -> DataFrame:
    """Keys by unverified email and a plain hash of the raw name and city."""
    prepared = clients.select(
        "row_no",
        "client_id",
        F.lower(F.trim(F.coalesce("email", F.lit("")))).alias("email"),
        normalize_phone("phone").alias("phone"),
        F.trim(F.coalesce("full_name", F.lit(""))).alias("full_name"),
        F.coalesce("city", F.lit("")).alias("city"),
        "revenue_rub",
    )
    name_city = F.upper(F.md5(F.concat_ws("|", "full_name", "city")))
    key = (
        F.when(F.col("phone") != "", F.concat(F.lit("phone:"), "phone"))
        .when(F.col("email") != "", F.concat(F.lit("email:"), "email"))
        .otherwise(F.concat(F.lit("name_city:"), name_city))
    )
    return prepared.withColumn("duplicate_key", key)


def duplicate_groups_simple(clients: DataFrame) -> DataFrame:
    """Groups of two or more records by the simple keys; ``client_id_list_simple`` has their ids."""
    grouped = _simple_keys(clients).groupBy("duplicate_key").agg(
        F.count(F.lit(1)).alias("records_in_group"),
        F.min("phone").alias("phone"),
        F.min("email").alias("email"),
        F.max("revenue_rub").alias("max_revenue"),
    )
    return grouped.filter("records_in_group > 1").orderBy(F.col("records_in_group").desc(), "duplicate_key")


def duplicate_records(keyed: DataFrame) -> DataFrame:
    """All raw records of groups with two or more, with the size of the group."""
    sizes = keyed.groupBy("duplicate_key").agg(F.count("client_id").alias("duplicate_group_size"))
    hot = hot_from_counts(sizes, "duplicate_key", "duplicate_group_size")
    return spread_join(keyed, sizes.filter("duplicate_group_size > 1"), "duplicate_key", "inner", hot=hot)


def client_quality(keyed: DataFrame) -> DataFrame:
    """Row counts and valid contacts before and after, from one row per group."""
    total = _groups(keyed).agg(
        long_sum("records").alias("rows_before"),
        F.count(F.lit(1)).alias("rows_after"),
        long_sum("phones").alias("phones_before"),
        long_sum("emails").alias("emails_before"),
        count_when(F.col("phone") != "").alias("phones_after"),
        count_when(F.col("email") != "").alias("emails_after"),
    )

    def quality(side: str) -> Column:
        valid = (F.col(f"phones_{side}") + F.col(f"emails_{side}")).cast("double")
        return rounded(F.try_divide(valid, F.col(f"rows_{side}") * 2) * 100, 1)

    def row(position: int, key: str, before: Column, after: Column) -> Column:
        return F.struct(
            F.lit(position).alias("position"),
            F.lit(fv.CLIENT_QUALITY_TITLES[key]).alias("metric"),
            before.cast("double").alias("before"),
            after.cast("double").alias("after"),
        )

    duplicates = F.col("rows_before") - F.col("rows_after")
    rows = [
        row(1, "rows", F.col("rows_before"), F.col("rows_after")),
        row(2, "duplicates", duplicates, F.lit(0)),
        row(3, "valid_phones", F.col("phones_before"), F.col("phones_after")),
        row(4, "valid_emails", F.col("emails_before"), F.col("emails_after")),
        row(5, "contact_quality", quality("before"), quality("after")),
    ]
    # Rows are compared before to after; found duplicates count as removed.
    change = F.col("after") - F.col("before")
    removed = F.col("position") <= 2
    delta = rounded(F.when(removed, -change).otherwise(change), 1)
    return total.select(F.inline(F.array(*rows))).withColumn("delta", delta)


def dictionary_profile(master: DataFrame, dictionary: dict[str, str] = fv.CLIENT_DICTIONARY) -> DataFrame:
    """Column descriptions with the number of clients that have a value."""
    columns: Sequence[str] = list(dictionary)
    counts = master.agg(*[count_when(F.trim(F.col(c).cast("string")) != "").alias(c) for c in columns])
    described = F.create_map(*[F.lit(x) for pair in dictionary.items() for x in pair])
    filled = to_long(counts, columns, name="column", value="filled_rows", cast="bigint")
    return filled.select("column", described[F.col("column")].alias("description"), "filled_rows")
