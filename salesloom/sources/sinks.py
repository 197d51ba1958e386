"""Writers: files for people, partitioned tables for later queries."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def append_log(df: DataFrame, path: str, file_format: str = "parquet") -> None:
    """Append events to a log; readers match the columns by name."""
    df.write.mode("append").format(file_format).option("header", True).save(path)


def write_monthly(df: DataFrame, path: str, date_column: str, sort_by: Sequence[str]) -> None:
    """A mart partitioned by month and sorted by key inside its files.

    Rows are ranged by month and sort key, so a month with most of the rows is spread over
    many tasks, and the value ranges of its files stay apart for pruning. Only the months
    present in ``df`` are replaced.
    """
    keys = ["month", *sort_by]
    (
        df.withColumn("month", F.date_format(F.col(date_column), "yyyy-MM"))
        .repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("month")
        .parquet(path)
    )


def touched_months(new_rows: DataFrame, date_column: str) -> list[str]:
    """The months that rows fall in, such as 2026-06: one row each comes to the driver."""
    month = F.date_format(F.col(date_column), "yyyy-MM").alias("month")
    return sorted(r["month"] for r in new_rows.select(month).filter("month IS NOT NULL").distinct().collect())


def in_months(df: DataFrame, column: str, months: Sequence[str]) -> DataFrame:
    """Rows of the given months; ranges on the bare column, so that they reach the scan."""
    kind = df.schema[column].dataType

    def one(month: str) -> Column:
        start = F.lit(f"{month}-01").cast("date")
        return (F.col(column) >= start.cast(kind)) & (F.col(column) < F.add_months(start, 1).cast(kind))

    return df.filter(reduce(lambda a, b: a | b, [one(m) for m in months], F.lit(False)))


def refresh_monthly(
    source: DataFrame,
    new_rows: DataFrame,
    mart: Callable[[DataFrame], DataFrame],
    path: str,
    date_column: str,
    mart_date: str,
    sort_by: Sequence[str],
) -> list[str]:
    """Bring a monthly mart up to date with ``new_rows``, which ``source`` holds already; the months it rewrote.

    Only months that new rows fall in are computed again, whole, from ``source``; the others stay as
    they are. ``mart`` must give a month from that month's source rows alone, so the table then
    equals one that is built at once. A repeated refresh writes the same months again.
    """
    months = touched_months(new_rows, date_column)
    if months:
        write_monthly(mart(in_months(source, date_column, months)), path, mart_date, sort_by)
    return months


def write_bucketed(df: DataFrame, name: str, path: str, key: str, buckets: int, sort_by: Sequence[str] = ()) -> None:
    """A table of the session catalog, dealt and sorted by ``key``.

    Joins and aggregates of such tables on the key need no exchange, if they have as many buckets.
    Rows are dealt before they are written, so each bucket is one file, and a join that
    needs order finds it.
    """
    dealt = df.repartition(buckets, key)
    writer = dealt.write.mode("overwrite").option("path", path).bucketBy(buckets, key)
    writer.sortBy(key, *sort_by).format("parquet").saveAsTable(name)


def read_monthly(spark: SparkSession, path: str, date_column: str, date_from: str, date_to: str) -> DataFrame:
    """Days ``date_from..date_to`` of a monthly mart; whole months are pruned by path."""
    months = F.col("month").between(date_from[:7], date_to[:7])
    days = F.to_date(F.col(date_column)).between(F.lit(date_from).cast("date"), F.lit(date_to).cast("date"))
    return spark.read.parquet(path).filter(months & days)


def write_report(df: DataFrame, path: str, report_date) -> None:
    """One folder per report date; writing a date again replaces that date only."""
    dated = df.withColumn("report_date", F.lit(str(report_date)))
    (
        dated.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("header", True)
        .partitionBy("report_date")
        .csv(path)
    )


