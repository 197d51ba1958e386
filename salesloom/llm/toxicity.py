"""Toxicity by weak supervision: many weak voters, a generative label model, a linear classifier.

Voters are lexicons, given or found in labelled documents, and patterns. A generative
label model estimates how accurate they are and how they depend on each other; its posterior labels
train a classifier on words and their beginnings, which scores all documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesloom.llm.co_training import MARKS, SYMBOL, UPPER, drawn
from salesloom.llm.common import small_batches, spread_out, table, written
from salesloom.llm.linear import SparseLogistic, sigmoid
from salesloom.llm.shingles import LOWERED, WORD, _BASE, _INVERSE, chunks, mixed, powers

LABELLED = 12_000  # labelled rows that lexicons are found in, about
TRAINED = 40_000  # rows the classifier is trained on, about
VOCABULARY = 4_000  # features of the classifier
SEEN = 3  # toxic documents a feature occurs in, at least
PRECISE = 0.8  # share of toxic ones among the documents with it, in found lexicons
EVIDENCE = 15.0  # log likelihood ratio against the overall share, in found lexicons
ANCHOR, FEW = 3, 20  # weight of a labelled row in the label model; labelled rows of a class to begin from
DISCOUNT = 0.5  # of a voter's say for each voter that it always agrees with
THRESHOLD = 0.7
# Words of abuse in English (fixed values).
SEED_WORDS = (
    ("idiot", "moron", "stupid", "dumb", "fool", "imbecile", "clown"),
    ("scum", "trash", "garbage", "filth", "vermin", "disgusting"),
    ("loser", "pathetic", "worthless", "useless", "coward", "hate"),
)
# Kinds of features: whole words and their first bytes, since stems of abuse take many endings.
KINDS = ("word", "first4", "first5", "first6", "first7", "first8")
PARTS = 2  # lexicons of a kind: two halves that vote on their own
PATTERNS = 3
VOTERS = len(SEED_WORDS) + len(KINDS) * PARTS + PATTERNS


def features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, kind and text number of every word and of its beginnings."""
    data = np.frombuffer(b"\0".join(texts) + b"\0", dtype=np.uint8)
    edges = np.flatnonzero(np.diff(np.concatenate([[False], WORD[data]]).astype(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(LOWERED[data] * powers(_BASE, len(data))[: len(data)], out=sums[1:])
    owner = np.searchsorted(np.cumsum([len(t) + 1 for t in texts]), starts, side="right").astype(np.int32)
    back, size = powers(_INVERSE, len(data)), ends - starts
    salts = mixed(np.arange(1, len(KINDS) + 1, dtype=np.uint64))
    hashes, kinds, owners = [], [], []
    for kind, name in enumerate(KINDS):
        n = int(name[-1]) if name[-1].isdigit() else 0
        use = slice(None) if not n else size > n
        a, b = starts[use], ends[use]
        if n:
            b = a + n
        hashes.append(mixed((sums[b] - sums[a]) * back[a] + salts[kind]))
        kinds.append(np.full(len(a), kind, np.int8))
        owners.append(owner[use])
    return np.concatenate(hashes), np.concatenate(kinds), np.concatenate(owners)


def word_feature(word: str) -> int:
    return int(features([word.encode()])[0][0])


def patterns(text: bytes) -> list[bool]:
    """Shouting, runs of exclamation, words masked with symbols."""
    counts = np.bincount(np.frombuffer(text, dtype=np.uint8), minlength=256)
    letters = counts[65:91].sum() + counts[97:123].sum()
    return [
        bool(letters > 20 and counts[UPPER].sum() > 0.7 * letters),
        b"!!!" in text or counts[MARKS].sum() * 20 > len(text) + 200,
        counts[SYMBOL].sum() * 10 > len(text) + 100,
    ]


class Lookup:
    """Which of some hashes are in a sorted list, and where; a table of their high bits rules most out."""

    def __init__(self, known: np.ndarray):
        self.known = known
        self.maybe = np.zeros(1 << 20, dtype=bool)
        self.maybe[known >> np.uint64(44)] = True

    def __call__(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions in ``hashes`` and in the list."""
        if not len(self.known):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        at = np.flatnonzero(self.maybe[hashes >> np.uint64(44)])
        where = np.minimum(np.searchsorted(self.known, hashes[at]), len(self.known) - 1)
        hit = self.known[where] == hashes[at]
        return at[hit], where[hit]


@dataclass
class Lexicons:
    """Sorted feature hashes, and the voters of each as bits; all are features of the classifier."""

    known: np.ndarray
    voters: np.ndarray


def _distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The different features of each labelled text, with its label."""
    for batch in batches:
        texts = [(t.as_py() or "").encode() for t in batch.column("text")]
        toxic = batch.column("toxic").to_numpy(zero_copy_only=False)
        for a, b in chunks(texts):
            hashes, kinds, owner = features(texts[a:b])
            order = np.lexsort((hashes, owner))
            hashes, kinds, owner = hashes[order], kinds[order], owner[order]
            new = np.concatenate([[True], (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])]) if len(hashes) else np.empty(0, bool)
            cut = np.searchsorted(owner[new], np.arange(b - a + 1)).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(cut), pa.array(hashes[new].view(np.int64)))
            kept = pa.ListArray.from_arrays(pa.array(cut), pa.array(kinds[new]))
            yield pa.RecordBatch.from_arrays([pa.array(toxic[a:b].astype(np.int32)), lists, kept], ["toxic", "feats", "kinds"])


def _counted(batches: Iterator[pa.RecordBatch], known: np.ndarray) -> Iterator[pa.RecordBatch]:
    """How many clean documents of this part hold each known feature."""
    lookup, counts = Lookup(known), np.zeros(len(known), dtype=np.int64)
    for batch in batches:
        feats = batch.column("feats")
        _, where = lookup(feats.flatten().to_numpy().view(np.uint64))
        counts += np.bincount(where, minlength=len(known))
    at = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], ["feature", "n"])


def found_lexicons(examples: DataFrame) -> Lexicons:
    """Features that toxic examples have and clean ones lack, dealt to voters by kind, and the seed words.

    Counts are taken by tasks; what reaches the driver are features of at least ``SEEN`` toxic examples
    of a bounded sample.
    """
    marked = written(examples.mapInArrow(_distinct, "toxic int, feats array<long>, kinds array<byte>"), "examples")
    sizes = {r["toxic"]: r["n"] for r in marked.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    pairs = marked.filter("toxic = 1").select(F.explode(F.arrays_zip("feats", "kinds")).alias("f"))
    often = pairs.groupBy(F.col("f.feats").alias("feat"), F.col("f.kinds").alias("kind")).agg(F.count("*").alias("n")).filter(F.col("n") >= SEEN)
    often = often.toArrow()
    known = often["feat"].to_numpy().view(np.uint64) if len(often) else np.empty(0, np.uint64)
    order = np.argsort(known)
    known = known[order]
    n1 = often["n"].to_numpy()[order] if len(often) else np.empty(0)
    kind = often["kind"].to_numpy()[order] if len(often) else np.empty(0, np.int8)
    clean = marked.filter("toxic = 0").mapInArrow(partial(_counted, known=known), "feature long, n long")
    n0 = np.zeros(len(known))
    for r in clean.groupBy("feature").agg(F.sum("n").alias("n")).collect():
        n0[r["feature"]] = r["n"]
    voters = np.zeros(len(known), dtype=np.int64)
    total1, total0 = max(sizes.get(1, 0), 1), max(sizes.get(0, 0), 1)
    share = total1 / (total1 + total0)
    seen = np.maximum(n1 + n0, 1)
    evidence = n1 * np.log(np.maximum(n1 / seen, 1e-12) / share) + n0 * np.log(np.maximum(n0 / seen, 1e-12) / (1 - share))
    precise = (n1 >= PRECISE * seen) & (evidence >= EVIDENCE)
    half = (known >> np.uint64(40)).astype(np.int64) % PARTS
    voters[precise] = np.int64(1) << (len(SEED_WORDS) + kind.astype(np.int64) * PARTS + half)[precise]
    # The classifier's features tell the classes apart either way.
    odds = np.log((n1 + 0.5) / (total1 + 1)) - np.log((n0 + 0.5) / (total0 + 1))
    keep = np.zeros(len(known), dtype=bool)
    keep[np.argsort(-np.abs(odds) * np.sqrt(n1), kind="stable")[:VOCABULARY]] = True
    keep |= precise
    bits = {int(h): int(v) for h, v in zip(known[keep], voters[keep])}
    for k, words in enumerate(SEED_WORDS):
        for h in map(word_feature, words):
            bits[h] = bits.get(h, 0) | 1 << k
    known = np.array(sorted(bits), dtype=np.uint64)
    return Lexicons(known, np.array([bits[int(h)] for h in known], dtype=np.int64))


def _votes(batches: Iterator[pa.RecordBatch], lexicons: Lexicons) -> Iterator[pa.RecordBatch]:
    """The voters that fire on each text as bits, and the known features it has."""
    lookup = Lookup(lexicons.known)
    for batch in batches:
        texts = [(t.as_py() or "").encode() for t in batch.column("text")]
        masks, lists = np.zeros(len(texts), dtype=np.int64), []
        for a, b in chunks(texts):
            hashes, _, owner = features(texts[a:b])
            at, where = lookup(hashes)
            pairs = np.unique(owner[at].astype(np.int64) << 32 | where)
            own, where = pairs >> 32, pairs & 0xFFFFFFFF
            np.bitwise_or.at(masks, a + own, lexicons.voters[where])
            cut = np.searchsorted(own, np.arange(b - a + 1))
            lists += [where[i:j].astype(np.int32) for i, j in zip(cut, cut[1:])]
        for k, text in enumerate(texts):
            for p, fires in enumerate(patterns(text)):
                masks[k] |= int(fires) << (VOTERS - PATTERNS + p)
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), batch.column("held_out"), pa.array(masks), pa.array(lists, pa.list_(pa.int32()))],
            ["id", "held_out", "votes", "feats"],
        )


class LabelModel:
    """The chance of toxicity given which voters fire, fitted by expectation maximisation.

    Each voter fires with a chance of its own in each class: its accuracy. How voters go together
    within the classes is estimated too, and the more a voter agrees with others beyond what the
    class explains, the less its vote adds. ``known`` is the label of a row of the table where one is
    given (-1: none); those rows anchor the classes, the others, nearly all, get their chance from
    the model. The table of votes has at most three times 2^VOTERS rows, whatever the number of
    documents.
    """

    def __init__(self, votes: np.ndarray, counts: np.ndarray, known: np.ndarray, rounds: int = 5):
        fires = fired_voters(votes)
        # To begin with, two votes of lexicons stand for toxicity.
        lexical = fires[:, : VOTERS - PATTERNS].sum(axis=1)
        belief = np.where(known >= 0, known, np.where(lexical >= 2, 0.95, np.where(lexical == 1, 0.3, 0.02)))
        weight = np.where(known >= 0, ANCHOR, 1.0) * counts
        anchored = all(counts[known == label].sum() >= FEW for label in (0, 1))
        self._fit(fires, weight * (known >= 0) if anchored else weight, belief)
        for _ in range(rounds):
            belief = np.where(known >= 0, known, self.posterior(votes))
            self._fit(fires, weight, belief)

    def _fit(self, fires: np.ndarray, weight: np.ndarray, belief: np.ndarray) -> None:
        self.chances, self.correlations, totals = [], [], []
        for w in (weight * (1 - belief), weight * belief):
            total = w.sum()
            self.chances.append((w @ fires + 0.5) / (total + 1))
            mean = w @ fires / (total + 1)
            spread = (fires * w[:, None]).T @ fires / (total + 1) - np.outer(mean, mean)
            deviation = np.sqrt(np.maximum(np.diag(spread), 0)) + 1e-6
            self.correlations.append(spread / np.outer(deviation, deviation))
            totals.append(total)
        self.prior = np.log((totals[1] + 0.5) / (totals[0] + 0.5))
        together = np.maximum(sum(self.correlations) / 2, 0)
        np.fill_diagonal(together, 0)
        self.says = 1 / (1 + DISCOUNT * together.sum(axis=1))

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        clean, toxic = self.chances
        fires = fired_voters(votes)
        evidence = fires * np.log(toxic / clean) + (1 - fires) * np.log((1 - toxic) / (1 - clean))
        return sigmoid(evidence @ self.says + self.prior)


def fired_voters(votes: np.ndarray) -> np.ndarray:
    return ((votes[:, None] >> np.arange(VOTERS)) & 1).astype(float)


def _scores(batches: Iterator[pa.RecordBatch], weights: np.ndarray, intercept: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        feats = batch.column("feats")
        size = feats.value_lengths().to_numpy(zero_copy_only=False)
        row = np.repeat(np.arange(len(size)), size)
        total = np.bincount(row, weights=weights[feats.flatten().to_numpy()], minlength=len(size)) + intercept
        yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("held_out"), pa.array(sigmoid(total))], ["id", "held_out", "score"])


def toxicity_scores(
    docs: DataFrame,
    labels: DataFrame,
    held_out,
    id_column: str = "doc_id",
    text_column: str = "text",
    labelled: int = LABELLED,
    trained: int = TRAINED,
) -> DataFrame:
    """Every document with ``held_out``, ``score`` (0 to 1) and ``predicted`` (1 from ``THRESHOLD`` on).

    ``labels`` has doc_id and toxic; ``held_out`` is a column of the id. Labels of held-out rows are not
    read, nor are held-out documents trained on. Only texts are input to a score. Lexicons are found in
    about ``labelled`` labelled rows, the classifier is trained on about ``trained`` rows; the label
    model sees the votes of all other rows, every document is scored on its whole text. Null texts
    are empty, their score that of a text without any feature; null ids are not trained on with
    labels; of several labels of an id the highest counts. Without toxic labels the seed words alone
    vote. Rows equal in id and text each come back. Other columns are not used.
    """
    spark = docs.sparkSession
    spread_out(spark)
    small_batches(spark)
    own = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))
    own = own.withColumn("held_out", F.coalesce(held_out(F.col("id")), F.lit(False)))
    known = labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy(F.col("doc_id").alias("id")).agg(F.max("toxic").alias("toxic"))
    known = drawn(known.filter(~held_out(F.col("id"))), labelled, "id")
    lexicons = found_lexicons(own.filter("NOT held_out").join(known, "id").select("toxic", "text"))
    voted = own.mapInArrow(partial(_votes, lexicons=lexicons), "id long, held_out boolean, votes long, feats array<int>")
    voted = written(voted, "votes")
    free = voted.filter("NOT held_out")
    counted = free.join(known, "id", "left").groupBy("votes", F.coalesce("toxic", F.lit(-1)).alias("label")).agg(F.count("*").alias("n"))
    counted = counted.orderBy("votes", "label").toArrow()
    votes, marks, counts = (counted[c].to_numpy() for c in ("votes", "label", "n"))
    width = len(lexicons.known)
    weights, intercept = np.zeros(width), -4.0
    if len(votes):
        model = LabelModel(votes, counts, marks)
        sample = drawn(free, trained, "id", "votes", "feats").select("votes", "feats").toArrow().combine_chunks()
        if len(sample):
            size = np.array([len(f) for f in sample["feats"]], dtype=np.int64)
            flat = np.concatenate([np.asarray(f.values if f.is_valid else [], dtype=np.int64) for f in sample["feats"]])
            weights, intercept = SparseLogistic(width, ridge=1e-5, steps=400).fit(flat, np.concatenate([[0], np.cumsum(size)]), model.posterior(sample["votes"].to_numpy()))
    scores = voted.mapInArrow(partial(_scores, weights=weights, intercept=intercept), "id long, held_out boolean, score double")
    return scores.select(F.col("id").alias(id_column), "held_out", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = lambda id_: F.pmod(F.crc32(id_.cast("string")), F.lit(3)) == 1
    return toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), held_out)
