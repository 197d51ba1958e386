"""Mixing sources to target weights: fixed-length blocks, multinomial draws per shard, permuted block numbers."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from fractions import Fraction
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from salesloom.llm.common import small_batches, spread_out, table, text_key, written
from salesloom.llm.shingles import mixed

BREAK = r"[\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)  # of the sources in the order of their names, repeating
PASSES = 3  # times a source is used up at most
BLOCK = 64  # words of a block
SHARD = 8192  # blocks of an output shard
BUCKET = 4096  # documents that are put in order together, about
TASK_SLOTS = 1 << 19  # slots that one task makes, about
RUN = 4096  # rows whose running total one task makes
SEED = 11


def targets(sizes: dict[str | None, int], weights: Sequence[int] = WEIGHTS, passes: int = PASSES) -> dict[str | None, Fraction]:
    """The words that the mix should take of each source; together as many as there are.

    Sources in code point order, null last, weigh ``weights`` in turn. A target stops at ``passes``
    times its source; what is above is shared out again by weight until no target is above.
    """
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    out: dict[str | None, Fraction] = {}
    left, free = Fraction(sum(sizes.values())), names
    while free:
        whole = sum(weight[s] for s in free)
        over = [s for s in free if left * weight[s] > passes * sizes[s] * whole]
        if not over:
            return out | {s: left * weight[s] / whole for s in free}
        out |= {s: Fraction(passes * sizes[s]) for s in over}
        left -= sum(out[s] for s in over)
        free = [s for s in free if s not in out]
    return out


def permuted(numbers: np.ndarray, n: int, *key: int) -> np.ndarray:
    """A pseudorandom permutation of 0 .. n - 1 that ``key`` chooses, at ``numbers``.

    Four Feistel rounds over the next power of four, repeated for what falls beyond ``n``.
    """
    half = np.uint64(max(1, -(-(n - 1).bit_length() // 2)))
    low = (np.uint64(1) << half) - np.uint64(1)
    salt = np.zeros(1, dtype=np.uint64)
    for k in key:
        salt = mixed(salt + np.uint64(k % (1 << 64)) + np.uint64(0x9E3779B97F4A7C15))
    rounds = [mixed(salt + np.uint64(r)) for r in range(1, 5)]
    out = numbers.astype(np.uint64)
    beyond = np.arange(len(out))
    while len(beyond):
        x = out[beyond]
        left, right = x >> half, x & low
        for r in rounds:
            left, right = right, left ^ (mixed(right + r) & low)
        out[beyond] = x = (left << half) | right
        beyond = beyond[x >= np.uint64(n)]
    return out.astype(np.int64)


def shard_counts(shard: int, slots: int, shares: np.ndarray, seed: int) -> np.ndarray:
    """How many of a shard's slots each source gets: the whole part of its expectation, and a multinomial draw of what is left.

    The parts that are drawn are fewer than the sources, so a source's words stay near its target
    on few shards as on many; each shard's draw depends on its number and the seed alone.
    """
    expected = shares * slots
    sure = np.floor(expected + 1e-9).astype(np.int64)
    left = int(slots - sure.sum())
    if left <= 0:
        return sure
    rest = np.maximum(expected - sure, 0)
    return sure + np.random.default_rng([seed, shard]).multinomial(left, rest / rest.sum())


def running_totals(df: DataFrame, group: str, order: str, value: str) -> DataFrame:
    """``df`` with ``before``, the sum of ``value`` over the rows of its group with a lower ``order`` (whole numbers from 0).

    Totals of runs of ``RUN`` numbers first, then inside each run, so that no task sees a whole group.
    """
    run = F.expr(f"{order} div {RUN}")
    runs = df.groupBy(group, run.alias("run")).agg(F.sum(value).alias("sum"))
    base = F.sum("sum").over(Window.partitionBy(group).orderBy("run")) - F.col("sum")
    runs = runs.select(group, "run", base.alias("base"))
    inside = F.sum(value).over(Window.partitionBy(group, "run").orderBy(order)) - F.col(value)
    found = df.withColumn("run", run).join(runs, [group, "run"])
    return found.withColumn("before", F.col("base") + inside).drop("run", "base")


def _draws(batches: Iterator[pa.RecordBatch], total: int, shares: list[float], seed: int, shard: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in batch.column("id").to_pylist():
            counts = shard_counts(k, min(shard, total - k * shard), np.array(shares), seed)
            of = np.flatnonzero(counts)
            n, inside = counts[of], np.cumsum(counts[of]) - counts[of]
            columns = [np.full(len(of), k), of, n, inside, np.full(len(of), int(counts.sum()))]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["shard", "source_no", "n", "inside", "slots"])


def _slots(batches: Iterator[pa.RecordBatch], blocks: list[int], seed: int, passes: int) -> Iterator[pa.RecordBatch]:
    names = ["shard", "position", "source_no", "pass", "block"]
    for batch in batches:
        for shard, source, n, inside, slots, before in zip(*[batch.column(c).to_pylist() for c in ("shard", "source_no", "n", "inside", "slots", "before")]):
            turn, index = np.divmod(np.arange(before, before + n), blocks[source])
            position = permuted(np.arange(inside, inside + n), slots, seed, 1, shard)
            block = np.empty(n, dtype=np.int64)
            for k in range(int(turn[0]), int(turn[-1]) + 1):
                block[turn == k] = permuted(index[turn == k], blocks[source], seed, 2, source, k)
            kept = turn < passes
            columns = [np.full(n, shard), position, np.full(n, source), turn, block]
            yield pa.RecordBatch.from_arrays([pa.array(c[kept], pa.int64()) for c in columns], names)


@dataclass
class Mixture:
    """A mix: ``documents`` (a row per input row), ``slots`` (a row per block taken) and ``block``, words of a block.

    ``documents``: id, key (of the text), source, source_no, size, source_size, target, and first,
    the words of its source before it (null where it has none of its own).
    ``slots``: shard, position (in the shard), source_no, pass (from 0), block (of the source).
    """

    documents: DataFrame
    slots: DataFrame
    block: int

    def pieces(self) -> DataFrame:
        """The parts of documents in each block: source_no, block, first (of the document), at (word in the document), words, place (in the block)."""
        own = self.documents.filter("size > 0")
        last = F.expr(f"(first + size - 1) div {self.block}")
        own = own.select("source_no", "first", "size", F.explode(F.sequence(F.expr(f"first div {self.block}"), last)).alias("block"))
        start = F.greatest(F.col("first"), F.col("block") * self.block)
        end = F.least(F.col("first") + F.col("size"), (F.col("block") + 1) * self.block)
        return own.select(
            "source_no", "block", "first", (start - F.col("first")).alias("at"), (end - start).alias("words"),
            (start - F.col("block") * self.block).alias("place"),
        )

    def taken(self) -> DataFrame:
        """``documents`` with ``taken``, the words of each that are in the mix, repeats counted."""
        # Slots are many more than the rows they are made of, by which Spark would judge their size.
        met = self.pieces().join(self.slots.hint("merge"), ["source_no", "block"])
        sums = met.groupBy("source_no", "first").agg(F.sum("words").alias("taken"))
        sums = sums.select(F.col("source_no").alias("s"), F.col("first").alias("f"), "taken")
        # Documents of a source begin at different words, but for those that have none.
        same = (F.col("source_no") == F.col("s")) & (F.when(F.col("size") > 0, F.col("first")) == F.col("f"))
        return self.documents.join(sums, same, "left").drop("s", "f").withColumn("taken", F.coalesce("taken", F.lit(0).cast("long")))

    def texts(self, docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source") -> DataFrame:
        """The mix itself: shard, position, source_no, pass, block and ``text``, the block's words joined by spaces.

        A block's words come from at most ``block`` documents; documents are cut where they are read.
        """
        small_batches(docs.sparkSession)
        text = F.col(text_column)
        own = docs.select(F.col(id_column).alias("i"), text_key(text).alias("k"), F.col(source_column).cast("string").alias("s"), text.alias("text")).dropDuplicates(["i", "k", "s"])
        same = F.col("id").eqNullSafe(F.col("i")) & (F.col("key") == F.col("k")) & F.col("source").eqNullSafe(F.col("s"))
        found = self.documents.filter("size > 0").join(own, same).select("source_no", "first", "text")
        cut = found.mapInArrow(partial(_cut, block=self.block), "source_no long, block long, place long, text string")
        parts = self.slots.hint("merge").join(cut, ["source_no", "block"]).groupBy(*self.slots.columns)
        parts = parts.agg(F.array_sort(F.collect_list(F.struct("place", "text"))).alias("parts"))
        return parts.select(*self.slots.columns, F.array_join("parts.text", " ").alias("text"))


def _cut(batches: Iterator[pa.RecordBatch], block: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows: list[tuple] = []
        for source, first, text in zip(*[batch.column(c).to_pylist() for c in ("source_no", "first", "text")]):
            words = [w for w in text.translate(SPACES).split(" ") if w]
            at = 0
            while at < len(words):
                number, place = divmod(first + at, block)
                rows.append((source, number, place, " ".join(words[at : at + block - place])))
                at += block - place
        columns = list(zip(*rows)) or [[]] * 4
        kinds = [pa.int64()] * 3 + [pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["source_no", "block", "place", "text"])


SPACES = {code: " " for code in range(9, 14)}


def word_count(text: Column) -> Column:
    return F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), BREAK), "")).cast("long")


def mixture(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    weights: Sequence[int] = WEIGHTS,
    passes: int = PASSES,
    block: int = BLOCK,
    shard: int = SHARD,
    seed: int = SEED,
) -> Mixture:
    """A mix of all sources with as many words as they have together, in shards of ``shard`` blocks.

    Each source's documents follow each other in a pseudorandom order and are cut into blocks of
    ``block`` words; the last may be shorter. The n-th slot that the shards give to a source takes
    the n-th block of a pseudorandom permutation, a new one each pass; slots beyond the last pass
    stay empty, so no word is taken more than ``passes`` times. Null and empty texts have no words
    and are in no block; a null source is a source; rows equal in id, text and source are
    documents of their own. Without any words there are no slots. The same rows give the same mix,
    however they are split. One row per source is gathered on the driver: sources are a list of names,
    not data. Other columns are not used.
    """
    spark = docs.sparkSession
    spread_out(spark)
    text = F.col(text_column)
    # Equal rows are one row here: they follow each other in the source.
    sized = docs.select(
        F.col(id_column).alias("id"), text_key(text).alias("key"), F.col(source_column).cast("string").alias("source"), word_count(text).alias("size")
    )
    sized = written(sized.groupBy("id", "key", "source", "size").agg(F.count("*").alias("copies")), "mix-sizes")
    sums = sized.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("words"), F.count("*").alias("n")).collect()
    sizes = {r["source"]: r["words"] for r in sums}
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    wanted = targets(sizes, weights, passes)
    blocks = [-(-sizes[s] // block) for s in names]
    rows = [(k, s, sizes[s], float(wanted[s])) for k, s in enumerate(names)]
    plan = spark.createDataFrame(rows, "source_no long, of string, source_size long, target double")
    known = sized.join(plan, F.col("source").eqNullSafe(F.col("of"))).drop("of")
    buckets = max(1, sum(r["n"] for r in sums) // BUCKET)
    known = known.withColumn("bucket", F.pmod(F.xxhash64(F.lit(seed), "id", "key"), F.lit(buckets)))
    per = known.groupBy("source_no", "bucket").agg(F.sum(F.col("size") * F.col("copies")).alias("words"))
    starts = running_totals(per, "source_no", "bucket", "words").select("source_no", "bucket", "before")
    own = Window.partitionBy("source_no", "bucket").orderBy(F.col("id").isNull(), "id", "key")
    whole = F.col("size") * F.col("copies")
    placed = known.filter("size > 0").join(starts, ["source_no", "bucket"]).withColumn("first", F.col("before") + F.sum(whole).over(own) - whole)
    placed = placed.unionByName(known.filter("size = 0"), allowMissingColumns=True)
    nth = F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)).alias("nth")
    documents = placed.select("id", "key", "source", "source_no", "size", "source_size", "target", "first", nth)
    documents = written(documents.withColumn("first", F.col("first") + F.col("nth") * F.col("size")).drop("nth"), "mix-documents")
    return Mixture(documents, _drawn(spark, [(wanted[s], sizes[s], b) for s, b in zip(names, blocks)], shard, seed, passes), block)


def _drawn(spark: SparkSession, sources: list[tuple[Fraction, int, int]], shard: int, seed: int, passes: int) -> DataFrame:
    """The slots of all shards. ``sources``: target, words and blocks of each."""
    # A block holds size / blocks words on average, the short last one included.
    slots = [target * blocks / size if size else Fraction(0) for target, size, blocks in sources]
    total = round(sum(slots))
    shares = [float(s / sum(slots)) if total else 0.0 for s in slots]
    draws = partial(_draws, total=total, shares=shares, seed=seed, shard=shard)
    schema = "shard long, source_no long, n long, inside long, slots long"
    drawn = written(spark.range(-(-total // shard)).mapInArrow(draws, schema), "mix-draws")
    numbered = running_totals(drawn, "source_no", "shard", "n").repartition(max(1, -(-total // TASK_SLOTS)), "shard")
    kinds = "shard long, position long, source_no long, pass long, block long"
    return numbered.mapInArrow(partial(_slots, blocks=[b for *_, b in sources], seed=seed, passes=passes), kinds)


def op11_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixture(table(spark, sf_dir, "documents")).taken()
    return found.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")
