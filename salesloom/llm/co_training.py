"""Document quality by co-training: one classifier sees the text, the other what is known about the page."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesloom.llm.common import small_batches, spread_out, table, text_key, written
from salesloom.llm.linear import fit_logistic, fit_platt, logit, sigmoid
from salesloom.llm.shingles import chunks, word_hashes

LABELLED = 20_000  # labelled rows the classifiers are fitted on, about; drawn by the hash of id and text
POOL = 20_000  # rows without label that pseudo-labels are drawn from, about
ROUNDS = 4
SHARE = 0.1  # of the pool that each view labels for the other in a round, the surest of each class
SURE = 0.9  # but none it is less sure of
HELD_BACK = 5  # every fifth labelled row calibrates the views and trains none
KEEP = 0.5  # documents that score less are rejected
SOURCES, LANGUAGES = 32, 8  # columns that source and language names are hashed to
TEXT_WIDTH = 14
META_WIDTH = 4 + SOURCES + LANGUAGES

SYMBOL, MARKS, UPPER, DIGIT, STOP = (
    np.isin(np.arange(256), list(chars.encode()))
    for chars in ("#*$%&<>@^~=+{}[]\\", "!?", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", ".,;:")
)


def text_view(texts: list[bytes]) -> np.ndarray:
    """How a text is written, whatever its words say: shares of kinds of characters, of repeated words."""
    out = np.zeros((len(texts), TEXT_WIDTH))
    for a, b in chunks(texts):
        hashes, owner = word_hashes(texts[a:b])
        first = np.searchsorted(owner, np.arange(b - a + 1))
        for k in range(b - a):
            data, own = np.frombuffer(texts[a + k], dtype=np.uint8), hashes[first[k] : first[k + 1]]
            size, n = max(len(data), 1), max(len(own), 1)
            counts = np.bincount(data, minlength=256)
            different, times = np.unique(own, return_counts=True)
            spaces = counts[32] + counts[9] + counts[10] + counts[13]
            out[a + k] = [
                counts[SYMBOL].sum() / size,
                counts[MARKS].sum() / size,
                counts[124] / size,
                counts[UPPER].sum() / size,
                counts[DIGIT].sum() / size,
                counts[STOP].sum() / size,
                counts[128:].sum() / size,
                spaces / size,
                (size - spaces) / n / 10,
                (own[1:] == own[:-1]).sum() / n,
                len(different) / n,
                (times.max() if len(times) else 0) / n,
                min(1.0, len(own) / 50),
                (own[2:] == own[:-2]).sum() / n,
            ]
    return out


def meta_view(batch: pa.RecordBatch, texts: list[bytes]) -> np.ndarray:
    """What is known about the page: its source, language and size, and how it is laid out in lines."""
    out = np.zeros((len(texts), META_WIDTH))
    source, lang = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("source_hash", "lang_hash"))
    for k, text in enumerate(texts):
        lines = text.count(b"\n") + 1
        longest = max(map(len, text.split(b"\n")))
        out[k, :4] = np.log1p(len(text)) / 10, np.log1p(lines) / 5, np.log1p(len(text) / lines) / 10, longest / (len(text) + 1)
    out[np.arange(len(texts)), 4 + source % SOURCES] = 1
    out[np.arange(len(texts)), 4 + SOURCES + lang % LANGUAGES] = 1
    return out


def _views(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [(t.as_py() or "").encode() for t in batch.column("text")]
        views = [text_view(texts), meta_view(batch, texts)]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("id"),
                batch.column("key"),
                *(pa.FixedSizeListArray.from_arrays(pa.array(v.astype(np.float32).ravel()), v.shape[1]).cast(pa.list_(pa.float32())) for v in views),
            ],
            ["id", "key", "text_view", "meta_view"],
        )


class CoTrained:
    """Two calibrated views of quality. Without labels of both classes every score is 0.5."""

    def __init__(self, labelled: tuple[np.ndarray, np.ndarray, np.ndarray], pool: tuple[np.ndarray, np.ndarray], rounds: int):
        *views, y = labelled
        order = np.arange(len(y))
        back = order % HELD_BACK == 0
        self.usable = all(0 < y[m].sum() < m.sum() for m in (back, ~back)) if len(y) else False
        if not self.usable:
            return
        self.scales = [(v.mean(axis=0), v.std(axis=0) + 1e-3) for v in views]
        known = [self._scaled(k, v[~back]) for k, v in enumerate(views)]
        free = [self._scaled(k, v) for k, v in enumerate(pool)]
        labels = [y[~back].astype(float)] * 2
        left = np.arange(len(free[0]))
        self.weights = [fit_logistic(x, t) for x, t in zip(known, labels)]
        for _ in range(rounds):
            if not len(left):
                break
            taken = np.zeros(len(left), dtype=bool)
            for k in (0, 1):
                sure = sigmoid(self._raw(k, free[k][left]))
                n = max(1, int(SHARE * len(left) / 2))
                for target, certain in ((1.0, sure), (0.0, 1 - sure)):
                    best = np.argsort(-certain, kind="stable")[:n]
                    best = best[certain[best] >= SURE]
                    # What one view is sure of becomes an example for the other.
                    known[1 - k] = np.concatenate([known[1 - k], free[1 - k][left[best]]])
                    labels[1 - k] = np.concatenate([labels[1 - k], np.full(len(best), target)])
                    taken[best] = True
            left = left[~taken]
            self.weights = [fit_logistic(x, t) for x, t in zip(known, labels)]
        self.prior = float(logit(np.array(y.mean())))
        self.platt = [fit_platt(self._raw(k, self._scaled(k, v[back])), y[back]) for k, v in enumerate(views)]

    def _scaled(self, k: int, view: np.ndarray) -> np.ndarray:
        mean, spread = self.scales[k]
        x = np.clip((view - mean) / spread, -8, 8)
        # Squares of the dense columns: too little and too much of something may both be bad.
        dense = x if k == 0 else x[:, :4]
        return np.column_stack([x, np.minimum(dense**2, 16)])

    def _raw(self, k: int, x: np.ndarray) -> np.ndarray:
        return x @ self.weights[k][:-1] + self.weights[k][-1]

    def scores(self, text: np.ndarray, meta: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Calibrated probability of good quality by text, by page, and by both as independent evidence."""
        if not self.usable:
            return (np.full(len(text), 0.5),) * 3
        own = [a * self._raw(k, self._scaled(k, v)) + b for (k, v), (a, b) in zip(enumerate((text, meta)), self.platt)]
        return sigmoid(own[0]), sigmoid(own[1]), sigmoid(own[0] + own[1] - self.prior)


def _matrix(column: pa.Array) -> np.ndarray:
    return np.stack(column.to_numpy(zero_copy_only=False)).astype(float) if len(column) else np.zeros((0, 1))


def _scored(batches: Iterator[pa.RecordBatch], model: CoTrained) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            scores = model.scores(_matrix(batch.column("text_view")), _matrix(batch.column("meta_view")))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("key"), *map(pa.array, scores)], ["id", "key", "text_score", "page_score", "score"]
            )


def drawn(rows: DataFrame, n: int, *keys: str) -> DataFrame:
    """About ``n`` of the rows at most, by the hash of ``keys``: the same ones each time, without one task that sorts.

    Rows that are equal in ``keys`` are drawn together and then come once, so no id that many rows
    share, null for instance, brings more than its different texts' part of ``n``.
    """
    total = rows.count()
    if total <= n:
        return rows
    chosen = rows.filter(F.pmod(F.xxhash64(F.lit("drawn"), *keys), F.lit(1 << 32)) < int((1 << 32) * n / total))
    return chosen.dropDuplicates(list(keys))


def quality_scores(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    labelled: int = LABELLED,
    pool: int = POOL,
    rounds: int = ROUNDS,
) -> DataFrame:
    """Every document (columns text, source, lang beside the id) with its scores and whether it is kept.

    ``labels`` has doc_id and quality, 1 good, 0 bad. Both views are fitted on about ``labelled``
    labelled rows; in each of ``rounds`` rounds each view labels those rows of a pool of about ``pool``
    documents that it is surest of as examples for the other. Every fifth labelled row is held back
    to calibrate them; the calibrated views are combined as independent evidence. Result: id, key,
    ``text_score``, ``page_score``, ``score`` (0 to 1) and ``kept`` (a score of at least ``KEEP``).
    All documents are scored, on whole texts. Null texts count as empty, null sources and languages as
    a name of their own; null ids and labels are left out of training, of several labels of an id
    the lowest counts. Rows equal in id and text each come back. Other columns are not used.
    """
    spark = docs.sparkSession
    spread_out(spark)
    small_batches(spark)
    own = docs.select(
        F.col(id_column).cast("long").alias("id"),
        text_key(F.col("text")).alias("key"),
        "text",
        F.pmod(F.xxhash64("source", F.col("source").isNull()), F.lit(1 << 30)).alias("source_hash"),
        F.pmod(F.xxhash64("lang", F.col("lang").isNull()), F.lit(1 << 30)).alias("lang_hash"),
    )
    schema = "id long, key long, text_view array<float>, meta_view array<float>"
    views = written(own.mapInArrow(_views, schema), "views")
    known = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy(F.col("doc_id").alias("id")).agg(F.min("quality").alias("quality"))
    # Both draws are bounded samples of numbers, not of texts.
    examples = drawn(views.join(known, "id"), labelled, "id", "key").orderBy("id", "key").toArrow()
    others = drawn(views.join(known, "id", "left_anti"), pool, "id", "key").orderBy("id", "key").toArrow()
    model = CoTrained(
        (_matrix(examples["text_view"]), _matrix(examples["meta_view"]), examples["quality"].to_numpy().astype(float)),
        (_matrix(others["text_view"]), _matrix(others["meta_view"])),
        rounds,
    )
    scores = views.mapInArrow(partial(_scored, model=model), "id long, key long, text_score double, page_score double, score double")
    return scores.select(F.col("id").alias(id_column), "key", "text_score", "page_score", "score", (F.col("score") >= KEEP).alias("kept"))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("key")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the classifier keeps, as they are."""
    scores = quality_scores(docs, table(spark, sf_dir, "labels")).filter("NOT kept")
    bad = written(scores.select(F.col("doc_id").alias("i"), F.col("key").alias("k")).distinct(), "rejected")
    same = F.col("doc_id").eqNullSafe(F.col("i")) & (text_key(F.col("text")) == F.col("k"))
    return docs.join(bad, same, "left_anti")
