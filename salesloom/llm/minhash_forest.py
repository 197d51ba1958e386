"""Near-duplicate documents: a MinHash LSH forest proposes, exact Jaccard similarity decides."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesloom.llm.common import LOWER, UPPER, small_batches, spread_out, table, text_key, written
from salesloom.llm.components import components
from salesloom.llm.shingles import THRESHOLD, MinHash, set_id, shingle_sets
from salesloom.llm.verify import blocked, link_groups, verified_links, with_sets

TREES = 40
DEPTH = 8  # labels of a tree, one byte each, most significant first
RECALL = 0.9999  # of links at the threshold, and as estimated from the links found


def chance(similarity, depth: int, trees: int = TREES):
    """That two documents share a prefix of ``depth`` labels in some tree; unequal values collide once in 256."""
    same = similarity + (1 - similarity) / 256
    return 1 - (1 - same**depth) ** trees


def _signed(batches: Iterator[pa.RecordBatch], trees: int) -> Iterator[pa.RecordBatch]:
    minhash = MinHash(trees * DEPTH)
    for batch in batches:
        texts = [(t.as_py() or "").encode() for t in batch.column("text")]
        classes, sizes, labels = [], [], []
        for shingles in shingle_sets(texts):
            classes.append(set_id(shingles))
            sizes.append(len(shingles))
            # One byte a value; a tree's eight bytes in order are its label.
            small = (minhash(shingles) * np.uint32(0x9E3779B1) >> np.uint32(24)).astype(np.uint8) if len(shingles) else None
            labels.append(None if small is None else small.reshape(trees, DEPTH).view(">u8").astype(np.int64).ravel())
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("id"),
                batch.column("key"),
                pa.array(classes, pa.binary()),
                pa.array(sizes, pa.int64()),
                pa.array(labels, pa.list_(pa.int64())),
            ],
            ["id", "key", "cls", "n", "labels"],
        )


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [(t.as_py() or "").encode() for t in batch.column("text")]
        sets = [s.astype("<u8").tobytes() for s in shingle_sets(texts)]
        what = batch.column("what")
        names = [f.name for f in what.type]
        yield pa.RecordBatch.from_arrays([*what.flatten(), pa.array(sets, pa.binary())], [*names, "shingles"])


def _prefix_links(forest: DataFrame, depth: int) -> DataFrame:
    """Classes that share a prefix of ``depth`` labels, each linked with the least of its trie node."""
    node = ["tree", F.shiftright("label", 8 * (DEPTH - depth)).alias("prefix")]
    at = forest.select("cls", *node)
    nodes = at.groupBy("tree", "prefix").agg(F.min("cls").alias("least"), F.max("cls").alias("most")).filter("least <> most")
    shared = at.join(written(nodes.drop("most"), "trie-nodes"), ["tree", "prefix"]).filter("cls <> least")
    return shared.select(F.col("cls").alias("a"), F.col("least").alias("b")).distinct()


def near_duplicates(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    trees: int = TREES,
    recall: float = RECALL,
) -> DataFrame:
    """Every document with its class of equal texts, its links and its group.

    Two texts are linked if they share at least ``THRESHOLD`` of their different shingles of five
    words. Texts with the same shingles are one class, ``class_id`` its least id; ``n_links`` counts
    the other classes linked to it; ``group_id`` is the least id that links lead to, over any number of
    links; ``n_copies`` the rows of the class. Of every class one member goes through the forest:
    sorted prefix tries over ``DEPTH`` labels in each tree, the matched prefix shortened from its
    full length until links at the threshold are found with probability ``recall``, and shortened
    further while the links found, each weighed by the chance it had, say that more are missing.
    Classes under one trie node form a candidate group, in which all pairs are compared exactly.
    A text without words (null, empty) has class and group of all such texts and no link; one of
    fewer than five words is one shingle. Null ids come last in the order; rows equal in id and
    text are one document and come back each. ``is_lead`` marks the document that a group is known by, ``text_key`` its
    text. Other columns are not used.
    """
    spark = docs.sparkSession
    spread_out(spark)
    small_batches(spark)
    own = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"), text_key(F.col(text_column)).alias("key"))
    schema = "id long, key long, cls binary, n long, labels array<long>"
    signed = written(own.withColumn("id", F.col("id").cast("long")).mapInArrow(partial(_signed, trees=trees), schema), "signatures")
    place = F.struct(F.col("id").isNull().alias("none"), "id", "key")
    classes = signed.groupBy("cls").agg(
        F.min(place).alias("first"), F.count("*").alias("n_copies"), F.first("n").alias("n"), F.first("labels").alias("labels")
    )
    classes = written(classes, "classes")
    # Beyond the first members' labels nothing of a class is needed to find candidates.
    forest = classes.filter("n > 0").select("cls", F.posexplode("labels").alias("tree", "label"))
    # Only a class's first member is looked up again; rows equal in id and text count once.
    texts = own.select("id", "key", "text")
    threshold = THRESHOLD[0] / THRESHOLD[1]
    depth = DEPTH
    while depth > 1 and chance(threshold, depth, trees) < recall:
        depth -= 1
    while True:
        groups = components(_prefix_links(forest, depth), "candidates")
        links = _links(texts, classes, groups, depth, trees)
        if depth == 1 or _estimated_recall(links) >= recall:
            break
        depth -= 1
    counts, linked = link_groups(links)
    summary = (
        classes.select("cls", "first", "n_copies")
        .join(counts, "cls", "left")
        .join(linked.withColumnRenamed("node", "cls"), "cls", "left")
        .select("cls", "first", "n_copies", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), F.coalesce("root", "cls").alias("root"))
    )
    summary = written(summary, "class-summary")
    leads = summary.groupBy("root").agg(F.min("first").alias("lead"))
    summary = written(summary.join(leads, "root").drop("root"), "class-groups")
    return signed.select("id", "key", "cls").join(summary, "cls").select(
        F.col("id").alias(id_column),
        F.col("first.id").alias("class_id"),
        F.col("lead.id").alias("group_id"),
        "n_links",
        "n_copies",
        (place == F.col("lead")).alias("is_lead"),
        F.col("key").alias("text_key"),
    )


def _links(own: DataFrame, classes: DataFrame, groups: DataFrame, depth: int, trees: int) -> DataFrame:
    members = blocked(groups.withColumnRenamed("node", "cls").join(classes.select("cls", "first", "n"), "cls"))
    what = F.struct("cls", "root", "blocks", "block", "pack").alias("what")
    wanted = members.select(F.col("first.id").alias("id"), F.col("first.key").alias("key"), what)
    schema = "cls binary, root binary, blocks int, block int, pack int, shingles binary"
    return verified_links(with_sets(own, wanted, _sets, schema), partial(chance, depth=depth, trees=trees))


def _estimated_recall(links: DataFrame) -> float:
    """Found links over the number they stand for, each weighed by one over its chance."""
    found, expected = links.agg(F.sum("links"), F.sum("weight")).first()
    return found / expected if expected else 1.0


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).drop("is_lead", "text_key")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group, the one that leads it; texts without words are one group."""
    found = near_duplicates(docs).filter("is_lead").select(F.col("doc_id").alias("i"), F.col("text_key").alias("k"))
    leads = written(found.distinct(), "leads")
    same = F.col("doc_id").eqNullSafe(F.col("i")) & (text_key(F.col("text")) == F.col("k"))
    return docs.join(leads, same, "left_semi").dropDuplicates(["doc_id", "text"])


# All pairs of texts that share a shingle, and everything that links reach: for small tables.
OP2_SQL = rf"""
WITH RECURSIVE d AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
                                      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), s AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                        ELSE list_sort(list_distinct([array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)])) END AS sh
    FROM d
), c AS (
    SELECT sh, min(doc_id) AS class_id, count(*) AS n_copies FROM s GROUP BY sh
), e AS (
    SELECT class_id, len(sh) AS n, unnest(sh) AS one FROM c
), links AS (
    SELECT a.class_id AS a, b.class_id AS b
    FROM e AS a JOIN e AS b ON a.one = b.one AND a.class_id <> b.class_id
    GROUP BY a.class_id, b.class_id, a.n, b.n HAVING 5 * count(*) >= 4 * (a.n + b.n - count(*))
), reached AS (
    SELECT class_id AS a, class_id AS b FROM c
    UNION SELECT r.a, l.b FROM reached AS r JOIN links AS l ON l.a = r.b
)
SELECT s.doc_id, c.class_id, g.group_id, coalesce(k.n_links, 0)::BIGINT AS n_links, c.n_copies
FROM s JOIN c ON c.sh = s.sh
JOIN (SELECT a, min(b) AS group_id FROM reached GROUP BY a) AS g ON g.a = c.class_id
LEFT JOIN (SELECT a, count(*) AS n_links FROM links GROUP BY a) AS k ON k.a = c.class_id
"""
