"""Connected components of links between 16-byte ids, by alternating star contraction."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesloom.llm.common import written


FEW_LINKS = 1 << 19  # one task holds so many in some 100 MB


def components(links: DataFrame, name: str = "components", few: int = 0) -> DataFrame:
    """``links`` (columns a, b) to rows ``node``, ``root``: the least id of the node's component.

    Each round links every node's larger neighbours to its least one (large star), then the smaller
    neighbours (small star). Nodes and links stay distributed, each round is a written table, and
    least ids are aggregated per task before the shuffle; the join with them meets plain shuffles,
    so a node with very many links can be split. The number of rounds grows with the logarithm of
    the longest chain. Links of a node with itself and nulls are left out: a node without other links has no row.
    Up to ``few`` links are followed in one task instead, which spares the rounds.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("a <> b")
    edges = written(edges.distinct(), name)
    if few and edges.count() <= few:
        return written(edges.coalesce(1).mapInArrow(_followed, "node binary, root binary"), name)
    while not _settled(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        edges = _star(both, F.col("v") > F.col("u"), name)
        edges = _star(edges, F.lit(True), name)
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    ).distinct()


def _settled(edges: DataFrame) -> bool:
    """Whether every node has one link up and none below it: then all links lead to a root."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        edges.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    )
    nodes = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return nodes.filter("up > 1 OR (up = 1 AND down = 1)").isEmpty()


def _star(edges: DataFrame, moved, name: str) -> DataFrame:
    """Link each node and its (moved) neighbours to the least of them."""
    least = written(edges.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), name)
    linked = edges.join(least, "u")
    out = linked.filter(moved).select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = least.select("u", F.col("m").alias("v"))
    both = out.unionByName(own).filter(F.col("u") != F.col("v"))
    return written(both.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), name)


def _followed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The least node that each one of all links leads to."""
    read = list(batches)
    if not read:
        return
    ends = pa.chunked_array([batch.column(c) for c in ("u", "v") for batch in read]).combine_chunks().dictionary_encode()
    order = pc.sort_indices(ends.dictionary).to_numpy()
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    u, v = rank[ends.indices.to_numpy()].reshape(2, -1)
    root = np.arange(len(order))
    while True:
        a, b = root[u], root[v]
        if (a == b).all():
            break
        # The larger root of each link goes under the least one that it meets, and all nodes go to their roots.
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while True:
            above = root[root]
            if (above == root).all():
                break
            root = above
    nodes = ends.dictionary.take(pa.array(order))
    yield pa.RecordBatch.from_arrays([nodes, nodes.take(pa.array(root))], ["node", "root"])
