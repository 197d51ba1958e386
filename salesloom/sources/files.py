"""Readers with a declared schema. Values that do not parse become NULL, never an error."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import reduce
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesloom.functions.periods import as_date
from salesloom.session import settings


def _parsed(field: T.StructField, timestamp_format: str | None) -> Column:
    text = F.trim(F.col(field.name))
    if isinstance(field.dataType, T.StringType):
        return F.col(field.name)
    if isinstance(field.dataType, T.TimestampNTZType) and timestamp_format:
        return F.try_to_timestamp(text, F.lit(timestamp_format)).cast("timestamp_ntz")
    return text.try_cast(field.dataType)


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    zero_fill: tuple[str, ...] = (),
    timestamp_format: str | None = None,
    **options,
) -> DataFrame:
    """CSV with a header, a file or a folder of files. Columns are matched by name and read as text, then converted.

    Files of a folder may have other columns, or the same ones in another order: those with the
    same header line are read together, one scan per different header. A missing path raises; a column
    that a file lacks is NULL. ``zero_fill`` names number columns whose missing values count as 0.
    """
    groups = _by_header(spark, path) or [path]
    parts = [_selected(spark.read.options(header=True, enforceSchema=False, **options).csv(files), schema, zero_fill, timestamp_format) for files in groups]
    return reduce(DataFrame.unionByName, parts)


def _selected(raw: DataFrame, schema: T.StructType, zero_fill: tuple[str, ...], timestamp_format: str | None) -> DataFrame:
    present = set(raw.columns)
    columns = []
    for field in schema:
        value = _parsed(field, timestamp_format) if field.name in present else F.lit(None).cast(field.dataType)
        if field.name in zero_fill:
            value = F.coalesce(value, F.lit(0).cast(field.dataType))
        columns.append(value.alias(field.name, metadata=field.metadata))
    return raw.select(*columns)


# A partition per file, which then ends after its first rows.
_ONE_FILE_EACH = {
    "spark.sql.files.maxPartitionBytes": str(1 << 40),
    "spark.sql.files.openCostInBytes": str(1 << 40),
    "spark.sql.execution.arrow.maxRecordsPerBatch": "16",
}


def _first_row(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            yield batch.slice(0, 1)
            return


def _by_header(spark: SparkSession, path: str) -> list[list[str]]:
    """The files at ``path``, those with the same first line together; empty files are left out.

    The first lines are read by one task per file, which stops there.
    """
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"))
    with settings(spark, _ONE_FILE_EACH):
        first = lines.mapInArrow(_first_row, "value string, file string").collect()
    groups: dict[str, list[str]] = defaultdict(list)
    for row in first:
        groups[row["value"].rstrip("\r")].append(unquote(row["file"]))
    return [sorted(groups[header]) for header in sorted(groups)]


def read_json_records(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Files that each hold one JSON array of flat records (an API payload)."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def date_slice(df: DataFrame, column: str, date_from, date_to) -> DataFrame:
    """Rows of the days ``date_from..date_to``; a range on the bare column, so it is pushed down."""
    kind = df.schema[column].dataType
    first, last = as_date(date_from), as_date(date_to)
    if isinstance(kind, T.DateType):
        return df.filter(F.col(column).between(first, last))
    start = F.lit(first).cast(kind)
    after = F.date_add(F.lit(last), 1).cast(kind)
    return df.filter((F.col(column) >= start) & (F.col(column) < after))


def default_report_date(df: DataFrame, column: str):
    """The last day in the data, for callers that give no date (one aggregate, one value)."""
    return df.agg(F.to_date(F.max(column)).alias("d")).first()["d"]
