"""Benchmark decontamination by winnowing: the least k-gram hash of every window meets those of the items."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesloom.llm.common import LOWER, UPPER, as_row, spread_out, table, text_key, words, written

WINDOW = 10  # words of a window that counts as a hit
GRAM = 5  # words of a fingerprinted gram: a window holds WINDOW - GRAM + 1 of them
SMALL_WORDS = 500_000  # items of so many words in all are broadcast; more are joined by shuffle
ANY_BREAK = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def _gram(at: Column, size: int, *seed: Column) -> Column:
    return F.xxhash64(*seed, *[F.get("words", at + k) for k in range(size)])


def _prints(texts: DataFrame, size: int) -> DataFrame:
    """``texts`` with ``prints``: per window its ``print`` and two hashes ``a``, ``b`` that tell its words.

    The print of a window of ``WINDOW`` words is the least of its gram hashes: equal windows have
    equal grams and so the same print, whatever stands around them. Its first and last gram
    together hold all its words: their hashes, 128 bits, are the window's identity. A shorter
    window is its own gram. Null where the text is shorter.
    """
    gram = GRAM if size == WINDOW else size
    per = size - gram + 1
    enough = F.size("words") >= size
    grams = F.transform(F.sequence(F.lit(0), F.size("words") - gram), lambda i: _gram(i, gram))
    hashed = texts.withColumn("grams", F.when(enough, grams))

    def window(i):
        least = F.least(*[F.get("grams", i + k) for k in range(per)]) if per > 1 else F.get("grams", i)
        last = F.get("grams", i + per - 1) if per > 1 else _gram(i, gram, F.lit(1))
        return F.struct(least.alias("print"), F.get("grams", i).alias("a"), last.alias("b"))

    prints = F.transform(F.sequence(F.lit(0), F.size("grams") - per), window)
    return hashed.withColumn("prints", F.when(F.size("grams") >= per, prints))


def item_windows(items: DataFrame) -> DataFrame:
    """Every different window of the items: ``size``, ``words`` and the ``items`` that have it."""
    texts = items.select("item", words(F.col("text")).alias("words")).filter(F.size("words") > 0)
    texts = texts.withColumn("size", F.least(F.size("words"), F.lit(WINDOW)))
    starts = texts.withColumn("at", F.explode(F.sequence(F.lit(0), F.size("words") - F.col("size"))))
    found = starts.select("item", "size", F.slice("words", F.col("at") + 1, F.col("size")).alias("words"))
    return found.groupBy("size", "words").agg(F.array_sort(F.collect_set("item")).alias("items"))


def _hits(docs: DataFrame, windows: DataFrame, size: int, small: bool) -> DataFrame:
    """Occurrences of item windows of ``size`` words in documents: id, key, at, size, items."""
    own = _prints(windows.filter(F.col("size") == size), size).select("items", F.inline_outer("prints"))
    found = _prints(docs, size)
    if small:
        own = F.broadcast(own)
    else:
        # Only documents that share a print go on; the prints are distinct per document.
        shared = found.select("id", "key", F.explode_outer(F.array_distinct("prints.print")).alias("print"))
        own = written(own, "item-prints")
        shared = written(shared.join(own, "print", "left_semi").select("id", "key").distinct(), "print-hits")
        shared = shared.select(F.col("id").alias("i"), F.col("key").alias("k"))
        found = found.join(shared, F.col("id").eqNullSafe(F.col("i")) & (F.col("key") == F.col("k")), "left_semi")
    # The outer form: for the inner one Spark infers a filter on the array, pushes it below the
    # projections and so computes the words anew for every window.
    at = found.select("id", "key", F.posexplode_outer("prints").alias("at", "w")).select("id", "key", "at", "w.*")
    # The fingerprint finds the candidate; its first and last gram extend it to the whole window.
    return at.join(own, ["print", "a", "b"]).select("id", "key", "at", F.lit(size).alias("size"), "items")


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
    small_words: int = SMALL_WORDS,
) -> DataFrame:
    """What each document shares with the benchmark items.

    Words are runs of ASCII letters and digits and of characters beyond ASCII, A-Z lower-cased. A
    window is ``WINDOW`` words in a row of an item; an item of fewer words is one window. Result:
    id, ``n_words``, ``n_hit`` (words inside an occurrence of a window), ``item_ids`` (the items
    whose windows occur, sorted as strings), ``contaminated``, and the input columns in ``row``.
    Every shared window is found: its least gram hash is the same on both sides; a hit is then
    extended to the whole window. Null and empty texts have no words, an empty item no window; an item without
    id marks words but is not listed. Repeated items count once. Rows equal in id and text are one
    document and come back each.
    """
    spread_out(docs.sparkSession)
    own = docs.select(
        F.col(id_column).alias("id"), F.col(text_column).alias("text"), text_key(F.col(text_column)).alias("key"), as_row(docs)
    )
    marks = items.select(F.col(item_column).cast("string").alias("item"), F.col(item_text_column).alias("text"))
    # The benchmark's own windows: few files.
    windows = written(item_windows(marks).coalesce(8), "item-windows")
    # At most WINDOW rows, of the benchmark alone: its window sizes and how many words they hold.
    sizes = {r["size"]: r["n"] for r in windows.groupBy("size").agg(F.count("*").alias("n")).collect()}
    small = sum(size * n for size, n in sizes.items()) <= small_words * WINDOW
    texts = own.select("id", "key", words(F.col("text")).alias("words"))
    hits = _hits(texts, windows, WINDOW, small)
    for size in sorted(set(sizes) - {WINDOW}):
        hits = hits.unionByName(_hits(texts, windows, size, small))
    # A passage that many documents share costs one row per occurrence; what meets in one group is one document's.
    per_doc = hits.groupBy("id", "key").agg(
        F.collect_set(F.struct("at", "size")).alias("spans"), F.collect_set("items").alias("lists")
    )
    covered = F.flatten(F.transform("spans", lambda s: F.sequence(s["at"], s["at"] + s["size"] - 1)))
    found = per_doc.select(
        F.col("id").alias("i"),
        F.col("key").alias("k"),
        F.size(F.array_distinct(covered)).cast("long").alias("n_hit"),
        F.array_sort(F.array_distinct(F.flatten("lists"))).alias("item_ids"),
    )
    pieces = F.array_remove(F.split(F.coalesce(F.col("text"), F.lit("")), ANY_BREAK), "")
    return (
        own.select("id", "key", "row", F.size(pieces).cast("long").alias("n_words"))
        .join(found, F.col("id").eqNullSafe(F.col("i")) & (F.col("key") == F.col("k")), "left")
        .select(
            F.col("id").alias(id_column),
            "n_words",
            F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
            F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
            F.col("n_hit").isNotNull().alias("contaminated"),
            "row",
        )
    )


def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without any window of a benchmark item."""
    found = decontaminate(docs, table(spark, sf_dir, "benchmark")).filter(~F.col("contaminated"))
    return found.select(*[F.col(f"row.{c}").alias(c) for c in docs.columns])


OP9_SQL = rf"""
WITH d AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
                                      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
    SELECT item_id::VARCHAR AS item, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
                                      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), iw AS (
    SELECT DISTINCT item, least(len(w), 10) AS n, list_slice(w, s, s + least(len(w), 10) - 1) AS win
    FROM (SELECT item, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS s FROM b WHERE len(w) > 0)
), dw AS (
    SELECT doc_id, n, s, list_slice(w, s, s + n - 1) AS win
    FROM (SELECT doc_id, n, w, unnest(range(1, len(w) - n + 2)) AS s FROM d, (SELECT DISTINCT n FROM iw) WHERE len(w) >= n)
), hits AS (
    SELECT doc_id, item, dw.n, s FROM dw JOIN iw ON iw.n = dw.n AND iw.win = dw.win
), covered AS (
    SELECT doc_id, count(DISTINCT p) AS n_hit
    FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM (SELECT DISTINCT doc_id, n, s FROM hits)) GROUP BY doc_id
), listed AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT doc_id, item FROM hits WHERE item IS NOT NULL) GROUP BY doc_id
)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(c.n_hit, 0)::BIGINT AS n_hit,
       coalesce(l.n_items, 0)::BIGINT AS n_items, sha256(coalesce(l.items, '')) AS items_sha256,
       c.n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN covered AS c ON c.doc_id = d.doc_id LEFT JOIN listed AS l ON l.doc_id = d.doc_id
"""
