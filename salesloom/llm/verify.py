"""Exact check of candidate links: every candidate group is cut into blocks, pairs of blocks are tasks' work.

A large group may first be divided by its members' rarest shingles, which loses no link.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesloom.llm.components import FEW_LINKS, components
from salesloom.llm.common import batch_rows, written
from salesloom.llm.shingles import THRESHOLD, component_labels, mixed, similar_pairs

BLOCK = 256  # members of a block, about
PACK = 1024  # members of small groups that are compared in one call, about
BLOCK_SHINGLES = 1 << 20  # shingles of a block, about
STAR_ROWS = 1 << 14  # rows of buckets that go to Python at a time


def blocked(groups: DataFrame, packs: int = 0) -> DataFrame:
    """``groups`` (cls, root, n shingles) with ``blocks``, how many its group has, its own ``block``, and the ``pack`` of a small group.

    A group of any size is spread over blocks by the hash of its members, so no task needs it whole.
    Packs are numbered from ``packs``.
    """
    sized = written(
        groups.groupBy("root").agg(
            F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("n") / BLOCK_SHINGLES)).cast("int").alias("blocks"),
            F.count("*").alias("size"),
        ),
        "group-blocks",
    )
    small = sized.filter("blocks = 1").agg(F.sum("size")).first()[0] or 0
    # Groups of one block go to packs of some hundred, others have a call per pair of blocks.
    pack = F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("root"), F.lit(-(-small // PACK) or 1)).cast("int") + packs).otherwise(-1)
    block = F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int")
    return groups.join(sized.drop("size"), "root").withColumns({"block": block, "pack": pack})


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The shingles of each member, told apart by its group, and a number that stands for the member."""
    for batch in batches:
        roots, ids = (np.array([int.from_bytes(x[:8], "little") for x in batch.column(c).to_pylist()], np.uint64) for c in ("root", "cls"))
        sets = [np.frombuffer(x, dtype="<u8") for x in batch.column("shingles").to_pylist()]
        sizes = np.array([len(s) for s in sets], np.int64)
        keys = mixed(np.concatenate([np.empty(0, np.uint64), *sets]) ^ np.repeat(mixed(roots), sizes)).view(np.int64)
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(keys))
        yield pa.RecordBatch.from_arrays([batch.column("cls"), pa.array(ids.view(np.int64)), pa.array(sizes), lists], ["cls", "member", "n", "keys"])


def _rarest(members: DataFrame) -> DataFrame:
    """The shingles (bucket) by which each member may have a link: cls, bucket.

    A link needs ``THRESHOLD`` of each side's shingles, so two linked members share one even if each of them leaves out
    its commonest, one short of that many; and a shingle that no other member of the group has links nothing.
    """
    part, whole = THRESHOLD
    keyed = members.mapInArrow(_keyed, "cls binary, member long, n long, keys array<long>")
    often = keyed.select("member", F.explode("keys").alias("bucket")).groupBy("bucket").agg(
        F.count("*").alias("often"), F.min("member").alias("low"), F.max("member").alias("high")
    )
    often = written(often.filter("low <> high").select("bucket", "often"), "shared-shingles")
    shared = keyed.select("cls", "n", F.explode("keys").alias("bucket")).join(often, "bucket")
    shared = shared.groupBy("cls", "n").agg(F.sort_array(F.collect_set(F.struct("often", "bucket"))).alias("shared"))
    # All but one less than a link needs; sorted, the rarest stand first.
    more = (F.size("shared") - F.ceil(F.col("n") * part / whole) + 1).cast("int")
    return shared.withColumn("more", more).filter("more > 0").select("cls", F.explode(F.slice("shared", F.lit(1), F.col("more"))).alias("one")).select("one.bucket", "cls")


def narrowed(members: DataFrame) -> DataFrame:
    """``members`` (as for ``verified_links``, and n) with each group of several blocks divided into groups between which no link is.

    Candidate groups join whatever chains of buckets lead to, such as all blocks around one common line, and
    grow faster than the table; their links are among members that share a rare shingle. Members that
    have no link go. Repeated as long as such groups deal out more rows than there are members, and that halves them.
    """

    def counted() -> tuple[int, int, int]:
        rows = F.sum(F.when(F.col("blocks") > 1, F.col("blocks")).otherwise(0))
        return members.agg(F.coalesce(rows, F.lit(0)), F.count("*"), F.coalesce(F.max("pack"), F.lit(-1)) + 1).first()

    members = written(members, "member-sets")
    rows, size, packs = counted()
    while rows > size:
        wide = members.filter("blocks > 1")
        groups = components(bucket_links(_rarest(wide), "rare-shingles"), "narrowed", FEW_LINKS)
        found = wide.select("cls", "n", "shingles").join(groups.withColumnRenamed("node", "cls"), "cls")
        found = written(blocked(found, packs), "narrowed-sets")
        members = members.filter("blocks = 1").unionByName(found.select(*members.columns))
        before = rows
        rows, _, packs = counted()
        if 2 * rows > before:
            break
    return members


def verified_links(members: DataFrame, chance: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
    """Links among the members of each group: cls, how many links, a linked class ``lead``, and ``weight``.

    ``weight`` sums one over the chance that candidate search finds a link of that similarity.

    ``members``: cls, root, blocks, block, pack, shingles (little-endian 64-bit numbers). Each member goes
    to every pair of its block with another; a pair of blocks compares its sets exactly and returns
    one row a member, not its pairs. The leads span the links: their components are those of all links.
    """
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = members.select("cls", "root", "block", "pack", "shingles", other.alias("other")).select(
        "cls",
        "root",
        "shingles",
        "block",
        "pack",
        F.when(F.col("pack") < 0, F.col("root")).alias("alone"),
        F.least("block", "other").alias("low"),
        F.greatest("block", "other").alias("high"),
    )
    compared = dealt.groupBy("pack", "alone", "low", "high").applyInPandas(
        lambda groups: _compare(groups, chance), "cls binary, links long, lead binary, weight double"
    )
    return written(compared, "links")


def _compare(groups: pd.DataFrame, chance: Callable[[np.ndarray], np.ndarray]) -> pd.DataFrame:
    """The groups of a pack, or one pair of blocks, each group for itself."""
    # A document that came in several rows is one member.
    low, high = groups["low"].iloc[0], groups["high"].iloc[0]
    found = {tuple(key): shingles for *key, shingles in zip(*(groups[c].tolist() for c in ("root", "block", "cls", "shingles")))}
    members = sorted(found)
    ids, blocks = [m[2] for m in members], np.array([m[1] for m in members])
    sets = [np.frombuffer(found[m], dtype="<u8") for m in members]
    edges = [0, *(k for k in range(1, len(members)) if members[k][0] != members[k - 1][0]), len(members)]
    out: list[tuple] = []
    for a, b in zip(edges, edges[1:]):
        split = None if low == high else int((blocks[a:b] == low).sum())
        linked, similarity = similar_pairs(sets[a:b], split)
        weight = np.zeros(linked.shape)
        weight[linked] = 1 / np.maximum(chance(similarity[linked]), 1e-9)
        weight = weight.sum(axis=1)
        labels, links = component_labels(linked), linked.sum(axis=1)
        out += [(ids[a + k], int(links[k]), ids[a + labels[k]], float(weight[k])) for k in np.flatnonzero(links).tolist()]
    return pd.DataFrame(out, columns=["cls", "links", "lead", "weight"])


def link_groups(links: DataFrame, few: int = 0) -> tuple[DataFrame, DataFrame]:
    """From ``verified_links``: links per class, and the component of each linked class (node, root)."""
    counts = links.groupBy("cls").agg(F.sum("links").alias("n_links"))
    return counts, components(links.select(F.col("cls").alias("a"), F.col("lead").alias("b")), "link-groups", few)


def with_sets(texts: DataFrame, wanted: DataFrame, sets: Callable[[Iterator], Iterator], schema: str) -> DataFrame:
    """Shingle sets of the wanted members, computed where the texts are after one join by document."""
    found = texts.alias("t").join(
        wanted.alias("w"), F.col("t.id").eqNullSafe(F.col("w.id")) & (F.col("t.key") == F.col("w.key"))
    )
    return found.select("t.text", "w.what").mapInArrow(sets, schema)


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows of one range: each member of a bucket with the least one before it; of the first and last bucket the least alone."""

    def rows(buckets, a, b):
        kinds = (pa.int64(), pa.binary(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, t) if isinstance(c, list) else c.cast(t) for c, t in zip((buckets, a, b), kinds)], ["bucket", "a", "b"])

    bucket, least, first = None, None, True
    for batch in batches:
        if not batch.num_rows:
            continue
        keys, members = batch.column("bucket").to_numpy(), batch.column("cls")
        start = np.flatnonzero(np.concatenate([[keys[0] != bucket], keys[1:] != keys[:-1]]))
        own = np.searchsorted(start, np.arange(len(keys)), side="right") - 1
        if own[0] < 0:  # goes on from the batch before
            n = int((own < 0).sum())
            yield rows(keys[:n].tolist(), members.slice(0, n), [least] * n)
        later = np.flatnonzero((own >= 0) & ~np.isin(np.arange(len(keys)), start))
        yield rows(keys[later].tolist(), members.take(pa.array(later)), members.take(pa.array(start[own[later]])) if len(later) else [])
        if len(start):
            bucket, least = int(keys[start[-1]]), members[int(start[-1])].as_py()
            if first:
                yield rows([int(keys[0])], [members[0].as_py()], [None])
                first = False
    if bucket is not None:
        yield rows([bucket], [least], [None])


def bucket_links(placed: DataFrame, name: str) -> DataFrame:
    """Links (a, b) of all members of a bucket with its least one; ``placed``: bucket (long), cls, each pair once.

    Rows are dealt once, in ranges that cut a bucket of any size. A bucket that goes on in the next range is
    linked by the least members of its parts, of which a range has two.
    """
    ranged = placed.select("bucket", "cls").repartitionByRange("bucket", "cls").sortWithinPartitions("bucket", "cls")
    with batch_rows(placed.sparkSession, STAR_ROWS):
        stars = written(ranged.mapInArrow(_stars, "bucket long, a binary, b binary"), name)
    ends = stars.filter("b IS NULL").select("bucket", "a").distinct()
    least = ends.groupBy("bucket").agg(F.min("a").alias("b"))
    return stars.filter("b IS NOT NULL").select("a", "b").unionByName(ends.join(least, "bucket").filter("a <> b").select("a", "b")).distinct()
