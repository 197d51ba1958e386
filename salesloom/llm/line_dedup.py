"""Removal of repeated runs of lines: overlapping windows of three lines, found over all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesloom.llm.common import as_row, spread_out, table, text_key, written

SIZE = 3


def _lines(text):
    return F.split(F.coalesce(text, F.lit("")), "\n")


def _windows(docs: DataFrame, size: int) -> DataFrame:
    """One row per window that is not all white space: id, key, first line ``at``, two 64-bit hashes."""

    def window(at):
        parts = [F.element_at("_lines", at + 1 + k) for k in range(size)]
        blank = F.trim(F.concat(*[F.translate(p, "\t\r", "  ") for p in parts])) == ""
        return F.when(
            ~blank,
            F.struct(at.alias("at"), F.xxhash64(*parts).alias("h1"), F.xxhash64(F.lit(1), *parts).alias("h2")),
        )

    starts = F.sequence(F.lit(0), F.size("_lines") - size)
    return (
        docs.select("id", "key", _lines(F.col("text")).alias("_lines"))
        .filter(F.size("_lines") >= size)
        .select("id", "key", F.explode(F.filter(F.transform(starts, window), lambda w: w.isNotNull())).alias("w"))
        .select("id", "key", "w.*")
    )


def line_dedup(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", size: int = SIZE) -> DataFrame:
    """Every document with the lines left after removing repeated windows of ``size`` lines.

    Lines are split at ``\\n`` and compared as they are. A window stays where it occurs first, in
    the order of id (null first), text key and line; all lines that a later occurrence covers go,
    in the same document too. A null or empty text has one empty line and no window; texts of
    fewer than ``size`` lines have no window; windows of white space only are no repeats. Rows
    equal in id and text are one document and come back each. Result: id, ``n_lines``,
    ``n_removed``, ``text`` (the lines that stay; null stays null) and ``row``, a struct of the
    input columns whatever their names.
    """
    spread_out(docs.sparkSession)
    own = docs.select(
        F.col(id_column).alias("id"),
        F.col(text_column).alias("text"),
        text_key(F.col(text_column)).alias("key"),
        as_row(docs),
    )
    windows = _windows(own, size)
    place = F.struct("id", "key", "at")
    # Counted per task before the shuffle, and written: the join below then meets plain shuffles
    # on both sides, which Spark can split for a hot window.
    repeated = written(
        windows.groupBy("h1", "h2")
        .agg(F.min(place).alias("first"), F.max(place).alias("last"))
        .filter(F.col("first") != F.col("last"))
        .select("h1", "h2", "first"),
        "line-windows",
    )
    later = windows.join(repeated, ["h1", "h2"]).filter(place != F.col("first"))
    covered = later.groupBy("id", "key").agg(F.collect_set("at").alias("starts"))
    marked = own.alias("d").join(
        covered.alias("c"), F.col("d.id").eqNullSafe(F.col("c.id")) & (F.col("d.key") == F.col("c.key")), "left"
    )
    lines = _lines(F.col("d.text"))
    gone = F.flatten(F.transform("c.starts", lambda s: F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda k: s + k)))
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone)
    text = F.array_join(F.transform("_kept", lambda i: F.element_at(F.col("_lines"), i + 1)), "\n")
    touched = F.col("_starts").isNotNull()
    return (
        marked.select(
            F.col("d.id").alias(id_column),
            F.col("d.text").alias("_text"),
            "row",
            F.col("c.starts").alias("_starts"),
            lines.alias("_lines"),
            kept.alias("_kept"),
        )
        .select(
            id_column,
            F.size("_lines").cast("long").alias("n_lines"),
            F.when(touched, F.size("_lines") - F.size("_kept")).otherwise(0).cast("long").alias("n_removed"),
            F.when(touched, text).otherwise(F.col("_text")).alias("text"),
            "row",
        )
    )


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup(table(spark, sf_dir, "documents")).drop("row")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with repeated lines removed; one of which nothing is left goes, one that was empty stays."""
    kept = line_dedup(docs).filter((F.col("n_removed") == 0) | (F.trim("text") != ""))
    own = {"text": F.col("text"), "n_chars": F.length("text").cast("long")}
    return kept.select(*[own.get(c, F.col(f"row.{c}")).alias(c) for c in docs.columns])


OP5_SQL = """
WITH lines AS (
    SELECT doc_id, text, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents
), windows AS (
    SELECT doc_id, s AS pos, ls[s + 1] || chr(10) || ls[s + 2] || chr(10) || ls[s + 3] AS w
    FROM (SELECT doc_id, ls, unnest(range(0, greatest(len(ls) - 2, 0))) AS s FROM lines)
), ranked AS (
    SELECT doc_id, pos, row_number() OVER (PARTITION BY w ORDER BY doc_id, pos) AS n
    FROM windows WHERE trim(w, ' ' || chr(9) || chr(10) || chr(13)) <> ''
), gone AS (
    SELECT DISTINCT doc_id, pos + k AS line FROM ranked, (SELECT unnest([0, 1, 2]) AS k) WHERE n > 1
), left_over AS (
    SELECT l.doc_id, string_agg(l.line, chr(10) ORDER BY l.pos) AS text, count(*) AS n
    FROM (SELECT doc_id, unnest(ls) AS line, unnest(range(0, len(ls))) AS pos FROM lines) AS l
    LEFT JOIN gone AS g ON g.doc_id = l.doc_id AND g.line = l.pos
    WHERE g.doc_id IS NULL GROUP BY l.doc_id
)
SELECT l.doc_id, len(l.ls)::BIGINT AS n_lines, (len(l.ls) - coalesce(k.n, 0))::BIGINT AS n_removed,
       CASE WHEN len(l.ls) = k.n THEN l.text ELSE coalesce(k.text, '') END AS text
FROM lines AS l LEFT JOIN left_over AS k ON k.doc_id = l.doc_id
"""
