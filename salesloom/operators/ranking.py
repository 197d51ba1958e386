"""Row numbers, latest versions and sequential ids that survive a hot key.

A window over ``PARTITION BY key`` puts all rows of a key in one task. The functions here
avoid that: they aggregate with map-side combine, or split a key by calendar buckets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def number_in_group(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    name: str,
    bucket: Column,
) -> DataFrame:
    """Add ``row_number() OVER (PARTITION BY keys ORDER BY order)`` as ``name``.

    Rows are numbered inside (keys, bucket), and the sizes of the earlier buckets of the key
    are added. So the largest window holds one bucket of one key, and the window over whole
    keys sees one small row per bucket.

    ``bucket`` must not decrease along ``order`` (for example the day of the first order
    column, or a range of row numbers; NULL comes first). Nothing runs before an action.
    """
    keys = list(keys)
    columns = df.columns
    group = [c for i, key in enumerate(keys) for c in _null_free(df, F.col(key), f"_key{i}")]
    part = _null_free(df, bucket, "_bucket")
    bucketed = df.select("*", *group, *part)
    group_cols = [name for i in range(len(keys)) for name in (f"_key{i}", f"_key{i}_null")]
    part_cols = ["_bucket", "_bucket_null"]

    earlier = (
        Window.partitionBy(*group_cols)
        .orderBy(F.col("_bucket_null").desc(), "_bucket")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = (
        bucketed.groupBy(*group_cols, *part_cols)
        .agg(F.count(F.lit(1)).alias("_size"))
        .select(*group_cols, *part_cols, F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_offset"))
    )
    inside = Window.partitionBy(*group_cols, *part_cols).orderBy(*order)
    number = (F.col("_inside") + F.col("_offset")).cast("bigint").alias(name)
    return (
        bucketed.withColumn("_inside", F.row_number().over(inside))
        .join(offsets, [*group_cols, *part_cols])
        .select(*columns, number)
    )


def number_lines(df: DataFrame, key: str, levels: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """Add ``row_number() OVER (PARTITION BY key ORDER BY levels, order)`` as ``name``, NULLs first.

    Lines are counted per key and levels with map-side combine. The counts of earlier first levels
    (days) of the key, and of earlier second levels (orders) of the first, are added to the number
    inside the second; so a window over a key sees a row per day, one over a day a row per order.
    """
    first, second = levels
    flat = [c for i, level in enumerate((key, first, second)) for c in _null_free(df, F.col(level), f"_l{i}")]
    marked = df.select("*", *flat)
    of = lambda *depth: [c for i in depth for c in (f"_l{i}", f"_l{i}_null")]
    nulls_first = lambda i: (F.col(f"_l{i}_null").desc(), F.col(f"_l{i}"))
    counts = marked.groupBy(*of(0, 1, 2)).agg(F.count(F.lit(1)).alias("_lines"))
    earlier = lambda keys, i: Window.partitionBy(*keys).orderBy(*nulls_first(i)).rowsBetween(Window.unboundedPreceding, -1)
    inner = counts.withColumn("_inner", F.coalesce(F.sum("_lines").over(earlier(of(0, 1), 2)), F.lit(0)))
    outer = counts.groupBy(*of(0, 1)).agg(F.sum("_lines").alias("_day"))
    outer = outer.withColumn("_outer", F.coalesce(F.sum("_day").over(earlier(of(0), 1)), F.lit(0))).drop("_day")
    offsets = inner.join(outer, of(0, 1)).select(*of(0, 1, 2), (F.col("_inner") + F.col("_outer")).alias("_before"))
    inside = Window.partitionBy(*of(0, 1, 2)).orderBy(*[F.col(c).asc_nulls_first() for c in order])
    return (
        marked.withColumn("_inside", F.row_number().over(inside))
        .join(offsets, of(0, 1, 2))
        .select(*df.columns, (F.col("_inside") + F.col("_before")).cast("bigint").alias(name))
    )


def _null_free(df: DataFrame, value: Column, name: str) -> list[Column]:
    """A value without NULLs and its NULL flag.

    Two plain columns let the window and the join below share one shuffle, which a
    null-safe comparison would not.
    """
    kind = df.select(value).schema[0].dataType
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        filler = F.lit("1970-01-01").cast(kind)
    elif isinstance(kind, T.StringType):
        filler = F.lit("")
    else:
        filler = F.lit(0).cast(kind)
    return [F.coalesce(value, filler).alias(name), value.isNull().alias(f"{name}_null")]


def latest_by(df: DataFrame, keys: Sequence[str], version: Sequence[str]) -> DataFrame:
    """One row per key: the one with the greatest ``version`` columns.

    An aggregate with map-side combine, so a key with very many versions shrinks to one
    row per task before the shuffle.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), F.struct(*version)).alias("_row")
    return df.groupBy(*keys).agg(newest).select(*keys, "_row.*").select(*df.columns)


def first_filled(value: str, order: str) -> Column:
    """Aggregate: the first non-blank value in the given order."""
    filled = F.trim(F.col(value)) != ""
    return F.coalesce(F.min_by(F.col(value), F.when(filled, F.col(order))), F.lit(""))


def key_ranges(df: DataFrame, key: str, side: int = 64) -> DataFrame:
    """Add ``_range``, a number that does not decrease along the unique text ``key`` (NULL first).

    The ``side`` ** 2 - 1 keys with the least hashes are a uniform sample of all keys, the same in
    every run; sorted, they cut the keys into ranges of about equal counts, whatever prefixes the
    keys share: a range holds 1 / ``side`` ** 2 of the rows on average, and with 4,095 cuts hardly
    ever more than a two hundredth. A row is compared with ``side`` cuts, then with ``side`` more.
    """
    least = df.filter(F.col(key).isNotNull()).select(F.col(key).alias("_cut")).orderBy(F.xxhash64("_cut"), "_cut")
    cuts = least.limit(side * side - 1).agg(F.array_sort(F.collect_list("_cut")).alias("_all"))
    blocks = F.transform(F.sequence(F.lit(0), F.lit(side - 1)), lambda i: F.slice("_all", i * side + 1, side))
    blocks = cuts.select(F.filter(blocks, lambda block: F.size(block) > 0)).scalar()

    ranged = df.withColumn("_blocks", blocks)
    # Blocks whose first cut is not above the key; the cuts of the last of them decide.
    block = F.size(F.filter("_blocks", lambda b: F.get(b, F.lit(0)) <= F.col(key)))
    ranged = ranged.withColumn("_block", block)
    inside = F.size(F.filter(F.get("_blocks", F.col("_block") - 1), lambda cut: cut <= F.col(key)))
    place = F.when(F.col("_block") > 0, (F.col("_block") - 1) * side + inside).otherwise(0)
    return ranged.withColumn("_range", place.cast("int")).drop("_blocks", "_block")


def sequential_ids(df: DataFrame, key: str, name: str, side: int = 64) -> DataFrame:
    """Number rows 1, 2, 3, ... in the order of the text ``key`` (which must be unique).

    Keys are numbered inside ranges (see ``key_ranges``), and the counts of the earlier ranges are
    added. The one window without a partition sees at most ``side`` ** 2 rows.
    """
    placed = key_ranges(df, key, side)
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy("_range")
        .agg(F.count(F.lit(1)).alias("_size"))
        .select("_range", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    )
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(key))
    return (
        placed.withColumn("_inside", inside)
        # Every range has a start. An inner join would have Spark check the ranges below their projection
        # for NULL, and so work out the key once per cut.
        .join(starts, "_range", "left")
        .withColumn(name, (F.col("_start") + F.col("_inside")).cast("bigint"))
        .drop("_range", "_inside", "_start")
    )
