"""A Merkle manifest of a dataset: postorder logs that aligned builders write, proofs read from closed-form positions."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from salesloom.llm.common import spread_out, table, written

FAN = 3  # nodes of a run
LEVELS = 7  # levels that one builder makes: FAN ** LEVELS nodes come to it at most
POWERS = tuple(FAN**m for m in range(40))  # all that fit in 64 bits


def digest(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def nodes_at(n: int, level: int) -> int:
    """Nodes of a level of a tree of ``n`` leaves."""
    return -(-n // FAN**level)


def height(n: int) -> int:
    """The level of the root, 0 of a lone leaf."""
    level = 0
    while nodes_at(n, level) > 1:
        level += 1
    return level


def position(n: int, level: int, index: int) -> int:
    """Where the log has a node: its place in completion order, from 0.

    A node is complete with its last leaf e. Before it stand e leaves, the nodes that are complete with
    earlier leaves, e // FAN ** m of each level m, and its own last descendants, one of each level below.
    """
    e = min((index + 1) * FAN**level, n) - 1
    return e + sum(e // FAN**m for m in range(1, height(n) + 1)) + level


def siblings(n: int, level: int, index: int) -> list[int]:
    """The other nodes of a node's run, left to right."""
    first = index - index % FAN
    return [k for k in range(first, min(first + FAN, nodes_at(n, level))) if k != index]


def subtree_nodes(n: int, leaves: list[str], base: int, first: int, levels: int = LEVELS) -> Iterator[tuple[int, int, str]]:
    """Level, index and digest of what a builder adds over the nodes ``first`` .. of level ``base``, in completion order.

    ``first`` is a multiple of FAN ** levels. In a tree of ``n`` leaves the nodes are all that
    follow up to the next such multiple or the tree's end; each level's last run may be short.
    """
    top = min(height(n) - base, levels)
    open_: list[list[str]] = [[] for _ in range(top + 1)]
    last = nodes_at(n, base) - 1
    for k, leaf in enumerate(leaves, first):
        open_[0].append(leaf)
        for level in range(1, top + 1):
            ended = (k + 1) % FAN**level == 0 or k == last
            if not ended:
                break
            node = digest(*open_[level - 1])
            open_[level - 1] = []
            open_[level].append(node)
            yield base + level, k // FAN**level, node


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one range, sorted by group: the range's number and the place among its rows of the group."""
    part, group, at = TaskContext.get().partitionId(), None, 0
    for batch in batches:
        places = []
        for g in batch.column("grp").to_pylist():
            group, at = (g, at + 1) if g == group else (g, 0)
            places.append(at)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array([part] * len(places), pa.int32()), pa.array(places, pa.int64())], [*batch.schema.names, "part", "place"]
        )


def in_order(rows: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``rows`` (with a string ``grp``, not null) with ``at``, the place in the group, and ``n``, rows of the group.

    Ranges of sorted rows are numbered one by one and the counts of earlier ranges added: a group of
    any size is many tasks' work, and a window sees one row per range.
    """
    ranged = rows.repartitionByRange("grp", *order).sortWithinPartitions("grp", *order)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema) + ", part int, place long"
    marked = written(ranged.mapInArrow(_numbered, schema), name)
    counts = marked.groupBy("grp", "part").agg(F.count("*").alias("c"))
    whole = Window.partitionBy("grp")
    before = F.sum("c").over(whole.orderBy("part")) - F.col("c")
    counts = counts.select("grp", "part", before.alias("before"), F.sum("c").over(whole).alias("n"))
    found = marked.join(counts, ["grp", "part"]).withColumn("at", F.col("before") + F.col("place"))
    return found.drop("before", "part", "place")


def _span(level: str) -> str:
    """Leaves below a node of a level, as SQL."""
    return f"element_at(array({', '.join(f'{p}L' for p in POWERS)}), {level} + 1)"


def _position(level: str, at: str, n: str) -> Column:
    """``position`` as a column; levels above the root add 0."""
    e = f"(least(({at} + 1) * {_span(level)}, {n}) - 1)"
    return F.expr(f"{e} + {level} + " + " + ".join(f"{e} div {p}L" for p in POWERS[1:]))


HEIGHT = f"size(filter(array({', '.join(f'{p}L' for p in POWERS)}), p -> p < n))"
IS_ROOT = f"at = 0 AND {_span('level')} >= n AND (level = 0 OR {_span('greatest(level - 1, 0)')} < n)"
NODES = "grp string, n long, level int, at long, digest string"


def _builder(base: int, levels: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def built(batch: pd.DataFrame) -> pd.DataFrame:
        batch = batch.sort_values("at", kind="stable")
        n, group = int(batch["n"].iloc[0]), batch["grp"].iloc[0]
        rows = [(group, n, *node) for node in subtree_nodes(n, batch["digest"].tolist(), base, int(batch["at"].iloc[0]), levels)]
        return pd.DataFrame(rows, columns=["grp", "n", "level", "at", "digest"])

    return built


def append_log(leaves: DataFrame, name: str, levels: int = LEVELS) -> DataFrame:
    """The logs of one tree per group: grp, n (leaves), level, at (index in the level) and digest.

    ``leaves``: grp, n, at, digest. A builder takes ``FAN ** levels`` nodes that begin at a multiple
    of as many and writes the nodes above them in completion order; the next round's builders take
    their roots, until each tree has one. Each round's nodes are a written table, no builder's work
    grows with a tree, and a lost one is built again alone.
    """
    log = level = leaves.select("grp", "n", F.lit(0).alias("level"), "at", "digest")
    base = 0
    while not (todo := level.filter(F.col("n") > F.lit(POWERS[base]))).isEmpty():
        builder = F.expr(f"at div {FAN**levels}L").alias("builder")
        made = written(todo.groupBy("grp", builder).applyInPandas(_builder(base, levels), NODES), name)
        log = log.unionByName(made)
        base += levels
        level = made.filter(F.col("level") == base)
    return log


@dataclass
class Manifest:
    """``leaves`` (the rows given, with at and n), ``log`` of the groups' trees, ``tops``, a row per group (at, its root ``digest``), and ``top_log`` of the tree over them."""

    leaves: DataFrame
    log: DataFrame
    tops: DataFrame
    top_log: DataFrame
    levels: int = LEVELS

    def entries(self) -> DataFrame:
        """Both logs as they are kept: ``top`` (the upper tree), grp, ``position``, level, digest; a log is sorted by position."""
        own = self.log.select(F.lit(False).alias("top"), "grp", _position("level", "at", "n").alias("position"), "level", "digest")
        upper = self.top_log.select(F.lit(True).alias("top"), "grp", _position("level", "at", "n").alias("position"), "level", "digest")
        return own.unionByName(upper)

    def proofs(self, claimed: str, *kept: str) -> DataFrame:
        """For every leaf: ``kept`` columns, leaf, subroot, root, ``proof`` (digests of all siblings, lowest level first), ``folded``.

        ``folded`` is the root that the column ``claimed``, a digest, gives with the siblings. Leaves are
        served in blocks of ``FAN ** levels``: a block reads its own stretch of the log and, by their positions, the
        few nodes that it needs of the levels above and of the tree over the groups.
        """
        levels, width = self.levels, FAN**self.levels
        inner = self.log.filter((F.col("level") > 0) & (F.col("level") < levels))
        inner = inner.select("grp", F.expr(f"at div element_at(array({', '.join(f'{p}L' for p in reversed(POWERS[: levels + 1]))}), level + 1)").alias("block"), F.lit(False).alias("top"), _position("level", "at", "n").alias("position"), "digest")
        leaves = self.leaves.withColumn("block", F.expr(f"at div {width}L"))
        tops = self.tops.select(F.col("of").alias("grp"), F.col("at").alias("top_at"), F.col("n").alias("top_n"))
        leaves = leaves.join(tops, "grp")
        blocks = leaves.groupBy("grp", "block").agg(F.first("n").alias("n"))
        upper = self.log.filter(F.col("level") >= levels).select(F.col("grp").alias("g"), _position("level", "at", "n").alias("p"), "digest")
        wanted = _wanted(blocks, "block", levels, "block")
        wanted = wanted.join(upper, (F.col("grp") == F.col("g")) & (F.col("position") == F.col("p")))
        wanted = wanted.select("grp", "block", F.lit(False).alias("top"), "position", "digest")
        top_log = self.top_log.select(_position("level", "at", "n").alias("p"), "digest")
        above = _wanted(self.tops.select("of", "at", "n"), "at", 0, "of").join(top_log, F.col("position") == F.col("p"))
        above = above.select(F.col("of").alias("grp"), "position", "digest")
        above = blocks.select("grp", "block").join(above, "grp").select("grp", "block", F.lit(True).alias("top"), "position", "digest")
        nodes = inner.unionByName(wanted).unionByName(above).toDF("of", "part", "top", "position", "digest")
        own = leaves.select("grp", "block", "at", "n", "top_at", "top_n", F.col("digest").alias("leaf"), F.col(claimed).alias("claimed"), *kept)
        schema = own.select(*kept).schema
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        found = own.groupBy("grp", "block").cogroup(nodes.groupBy("of", "part")).applyInPandas(
            lambda a, b: _proved(a, b, list(kept)), f"{fields}, leaf string, subroot string, root string, proof array<string>, folded string"
        )
        return found


def _wanted(nodes: DataFrame, at: str, base: int, *kept: str) -> DataFrame:
    """Positions of the siblings, from level ``base`` on, of the nodes ``at`` of that level and above them, and of the root if it is as high."""
    spans = ", ".join(f"{p}L" for p in POWERS)
    own = f"{at} div element_at(array({spans}), level - {base} + 1)"
    levels = nodes.select("*", F.expr(f"explode(sequence({base}, {base} + greatest({HEIGHT} - {base}, 0)))").alias("level"), F.expr(HEIGHT).alias("h"))
    levels = levels.filter("level <= h").withColumn("own", F.expr(own))
    every = levels.select("*", F.expr("explode(CASE WHEN level = h THEN array(0L) ELSE sequence(own - own % 3, own - own % 3 + 2) END)").alias("k"))
    some = every.filter(f"level = h OR (k <> own AND k * {_span('level')} < n)")
    return some.select(*{c: 0 for c in ("grp", *kept) if c in nodes.columns}, _position("level", "k", "n").alias("position"))


def _proved(leaves: pd.DataFrame, nodes: pd.DataFrame, kept: list[str]) -> pd.DataFrame:
    if not len(leaves):
        return pd.DataFrame(columns=[*kept, "leaf", "subroot", "root", "proof", "folded"])
    leaves = leaves.sort_values("at", kind="stable")
    n, top_at, top_n = (int(leaves[c].iloc[0]) for c in ("n", "top_at", "top_n"))
    known = {(t, p): d for t, p, d in zip(nodes["top"], nodes["position"], nodes["digest"])}
    first, digests = int(leaves["at"].iloc[0]), leaves["leaf"].tolist()
    tall = height(n)

    @lru_cache(None)
    def node(top: bool, level: int, index: int) -> str:
        if not top and level == 0:
            return digests[index - first]
        return known[top, position(top_n if top else n, level, index)]

    @lru_cache(None)
    def run(top: bool, level: int, index: int) -> tuple[str, str]:
        """The siblings before and after a node."""
        others = siblings(top_n if top else n, level, index)
        return "".join(node(top, level, k) for k in others if k < index), "".join(node(top, level, k) for k in others if k > index)

    above = [run(True, level, top_at // FAN**level) for level in range(height(top_n))]
    subroot = node(False, tall, 0) if tall else digests[0]
    root = node(True, height(top_n), 0)
    out = []
    for at, claimed in zip(leaves["at"].tolist(), leaves["claimed"].tolist()):
        steps = [run(False, level, at // FAN**level) for level in range(tall)] + above
        for before, after in steps:
            claimed = digest(before, claimed, after)
        joined = "".join(before + after for before, after in steps)
        out.append(([joined[k : k + 64] for k in range(0, len(joined), 64)], claimed))
    found = leaves[kept].copy()
    found["leaf"], found["subroot"], found["root"] = digests, subroot, root
    found["proof"], found["folded"] = [p for p, _ in out], [f for _, f in out]
    return found


def manifest(leaves: DataFrame, order: list[Column], name: str = "merkle", levels: int = LEVELS) -> Manifest:
    """Merkle trees over ``leaves`` (grp: a string, not null; digest: lowercase hex; more columns), one per group, and one over their roots.

    In a group leaves stand in ``order``; groups ascend bytewise. While a tree has several
    nodes, each run of ``FAN`` consecutive ones (the last may be shorter, even one) becomes the SHA-256
    of their digests' hex text; a lone leaf is its own root. Without rows all results are empty.
    """
    spread_out(leaves.sparkSession)
    ordered = written(in_order(leaves, order, f"{name}-ranked"), f"{name}-leaves")
    log = append_log(ordered, f"{name}-log", levels)
    roots = log.filter(IS_ROOT).select(F.lit("").alias("grp"), F.col("grp").alias("of"), "digest")
    tops = written(in_order(roots, [F.col("of")], f"{name}-groups"), f"{name}-roots")
    return Manifest(ordered, log, tops, append_log(tops, f"{name}-top", levels), levels)


FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def leaf_digest(fields: list[Column]) -> Column:
    """SHA-256 of the fields' texts, each after its length in bytes and a colon, a null as ``-``: no two rows read alike."""
    said = [c.cast("string") for c in fields]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-")) for c in said]), 256)


def document_leaves(docs: DataFrame) -> DataFrame:
    """Documents as leaves: doc_id, grp, digest, and ``tampered``, that of the text without line breaks where 2 divides the CRC-32 of the id.

    Null columns are fields of their own; a null id is in no tampering. ``grp`` orders sources bytewise, null first.
    """
    text = F.col("text")
    gone = (F.crc32(F.col("doc_id").cast("string")) % 2 == 0) & F.contains(text, F.lit("\n"))
    own, other = (leaf_digest([*[F.col(c) for c in FIELDS[:-1]], t]) for t in (text, F.replace(text, F.lit("\n"), F.lit(""))))
    grp = F.coalesce(F.concat(F.lit("1"), "source"), F.lit("0"))
    leaves = docs.select("doc_id", grp.alias("grp"), own.alias("digest"), F.when(gone, other).alias("tampered"))
    # Equal rows may stand in any order: their leaves are equal.
    return leaves.withColumn("tampered", F.coalesce("tampered", "digest"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    leaves = document_leaves(table(spark, sf_dir, "documents"))
    made = manifest(leaves, [F.col("doc_id").isNull(), F.col("doc_id"), F.col("digest")])
    found = made.proofs("tampered", "doc_id")
    return found.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        F.sha2(F.array_join("proof", ""), 256).alias("proof_sha256"),
        F.col("folded").alias("folded_root"),
        (F.col("folded") == F.col("root")).alias("verified"),
    )


OP12_SQL = r"""
WITH RECURSIVE crc AS (
    SELECT doc_id, xor(4294967295::BIGINT, list_reduce(
        list_concat([4294967295::BIGINT], list_transform(range(1, len(doc_id::VARCHAR) + 1), lambda i: ascii(substr(doc_id::VARCHAR, i, 1))::BIGINT)),
        lambda c, b: list_reduce(list_concat([xor(c, b)], [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
                                 lambda x, z: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END))) AS crc
    FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL)
), fields AS (
    SELECT d.doc_id, source, text, crc.crc % 2 = 0 AS hit,
           coalesce(strlen(d.doc_id::VARCHAR) || ':' || d.doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
           || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head
    FROM documents AS d LEFT JOIN crc ON crc.doc_id = d.doc_id
), leaves AS (
    SELECT doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
           sha256(head || CASE WHEN text IS NULL THEN '-' WHEN hit THEN strlen(replace(text, chr(10), '')) || ':' || replace(text, chr(10), '')
                               ELSE strlen(text) || ':' || text END) AS claimed
    FROM fields
), ranked AS (
    SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS g, count(*) OVER (PARTITION BY source) AS n,
           row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS LAST, leaf) - 1 AS pos
    FROM leaves
), up AS (
    SELECT g, 0 AS level, pos, n, leaf AS d FROM ranked
    UNION ALL
    SELECT g, level + 1, pos // 3, (n + 2) // 3, sha256(string_agg(d, '' ORDER BY pos)) FROM up WHERE n > 1 GROUP BY g, level, pos // 3, n
), subroots AS (
    SELECT g, d, (SELECT count(DISTINCT g) FROM up) AS n FROM up WHERE n = 1
), top AS (
    SELECT 0 AS level, g AS pos, n, d FROM subroots
    UNION ALL
    SELECT level + 1, pos // 3, (n + 2) // 3, sha256(string_agg(d, '' ORDER BY pos)) FROM top WHERE n > 1 GROUP BY level, pos // 3, n
), lower_steps AS (
    SELECT a.g, a.level, a.pos, coalesce(string_agg(b.d, '' ORDER BY b.pos) FILTER (WHERE b.pos < a.pos), '') || '|'
           || coalesce(string_agg(b.d, '' ORDER BY b.pos) FILTER (WHERE b.pos > a.pos), '') AS step
    FROM up AS a JOIN up AS b ON b.g = a.g AND b.level = a.level AND b.pos // 3 = a.pos // 3 WHERE a.n > 1 GROUP BY a.g, a.level, a.pos
), upper_steps AS (
    SELECT a.level, a.pos, coalesce(string_agg(b.d, '' ORDER BY b.pos) FILTER (WHERE b.pos < a.pos), '') || '|'
           || coalesce(string_agg(b.d, '' ORDER BY b.pos) FILTER (WHERE b.pos > a.pos), '') AS step
    FROM top AS a JOIN top AS b ON b.level = a.level AND b.pos // 3 = a.pos // 3 WHERE a.n > 1 GROUP BY a.level, a.pos
), steps AS (
    SELECT g, pos, list(step ORDER BY k) AS steps
    FROM (
        SELECT r.g, r.pos, s.level AS k, step FROM ranked AS r JOIN lower_steps AS s ON s.g = r.g AND s.pos = r.pos // pow(3, s.level)::BIGINT
        UNION ALL
        SELECT r.g, r.pos, 1000 + s.level, step FROM ranked AS r JOIN upper_steps AS s ON s.pos = r.g // pow(3, s.level)::BIGINT
    ) GROUP BY g, pos
), folded AS (
    SELECT doc_id, leaf, u.d AS subroot, (SELECT d FROM top WHERE n = 1) AS root, coalesce(steps, []) AS steps,
           list_reduce(list_concat([claimed], coalesce(steps, [])),
                       lambda d, s: sha256(split_part(s, '|', 1) || d || split_part(s, '|', 2))) AS folded_root
    FROM ranked AS r JOIN subroots AS u ON u.g = r.g LEFT JOIN steps AS s ON s.g = r.g AND s.pos = r.pos
)
SELECT doc_id, leaf, subroot, root, sha256(replace(coalesce(array_to_string(steps, ''), ''), '|', '')) AS proof_sha256,
       folded_root, folded_root = root AS verified
FROM folded
"""
