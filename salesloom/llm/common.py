"""Shared helpers: the shared folder, written intermediate tables and document keys."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# One word is a run of ASCII letters or digits and of characters beyond ASCII.
WORD_BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, which driver and executors share.

    Where the setting is missing (a local session, as in tests) a temporary folder is made once
    and kept in the session; a cluster without the setting is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("salesloom.llm.folder", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    folder = "file://" + tempfile.mkdtemp(prefix="salesloom-llm-")
    spark.conf.set("salesloom.llm.folder", folder)
    return folder


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table of the shared folder: its lineage ends there, and a lost executor costs no rerun."""
    path = new_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower case for A-Z only. Pure ASCII takes the fast function, with the same result."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def words(text: Column) -> Column:
    """The lower-cased words of a text; none for null."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), WORD_BREAK), "")


def text_key(text: Column) -> Column:
    """Tells apart rows of one id with different texts; rows equal in id and text are one document."""
    return F.xxhash64(F.coalesce(text, F.lit("")), text.isNull())


def as_row(df: DataFrame) -> Column:
    """All columns of an input in one struct, so that their names clash with no column of an operator."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")


def spread_out(spark: SparkSession) -> None:
    """Have hot join keys split also where the next operator then needs a shuffle of its own."""
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")


def release(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of finished jobs now: its cleaner acts when the driver's garbage is collected."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def small_batches(spark: SparkSession) -> None:
    """Few rows at a time go to Python workers: texts may be long."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "256")


@contextmanager
def batch_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """For jobs run inside: so many rows at a time go to Python workers, where rows are short."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)
