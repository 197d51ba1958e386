"""Packing documents into sequences of a fixed length: linear grouping with few-size patterns, or best fit.

Only the histogram of piece lengths, at most ``capacity`` rows whatever the data, is planned on the
driver. The plan says which ranks of a length go into which sequences; pieces are ranked and placed
by Spark.
"""

from __future__ import annotations

import gc
import re
import zlib
from collections.abc import Iterator
from functools import partial
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from salesloom.llm.common import small_batches, table, written
from salesloom.llm.shingles import chunks

CAPACITY = 2048
GROUPS = 96  # groups of equal cardinality that large lengths are rounded up within
LARGE = 8  # a length above capacity / LARGE is large
OPTIMAL = 1e-3  # the patterns used are within this share of the best
END = 0  # id that ends every document
KNOWN_WORDS = 800_000  # encoded words a worker remembers at once
SHORT = 8  # characters of a word that stays when others make room
LONGEST_KNOWN = 64  # characters of a remembered word
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, nth long"


STOP = re.compile(r"[.,](?=[ \n]|\Z)")
OTHER_STOP = re.compile(r"(?:[^a-z\xdf-\xf6\xf8-\xff]|\A)[.,](?:[ \n]|\Z)")  # not after a letter


# The letters that byte-level tokenizers write for bytes which are no visible Latin-1 characters.
_HIDDEN = [c for c in range(256) if not (33 <= c <= 126 or 161 <= c <= 172 or 174 <= c)]
BYTE_LETTERS = {c: 256 + k for k, c in enumerate(_HIDDEN)}


def _apart(text: str) -> str:
    """Blanks where the tokenizer cuts anyway: between a letter and a last full stop or comma.

    Texts in Latin-1 are lower-cased, as the tokenizer does it. Fewer different words are left.
    """
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return text
    text = text.lower()
    if not OTHER_STOP.search(text):
        for stop in ".,":
            text = text.replace(f"{stop} ", f" {stop} ").replace(f"{stop}\n", f" {stop}\n")
        return f"{text[:-1]} {text[-1]}" if text[-1:] in (".", ",") else text
    return STOP.sub(lambda m: " " + m[0] if text[m.start() - 1 : m.start()].isalpha() else m[0], text)


class WordEncoder:
    """Ids of texts as little-endian 32-bit numbers.

    The tokenizer drops white space and encodes what stands between on its own, so texts are cut at
    blanks and line ends, and each different word is encoded once while it is remembered. New words
    of some texts are encoded in one go and told apart by the place that each id comes from.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.known: dict[str, bytes] = {"": b""}

    def __call__(self, texts: list[str]) -> Iterator[bytes]:
        if len(self.known) > KNOWN_WORDS:
            # Short words come again the most.
            short = {p: ids for p, ids in self.known.items() if len(p) <= SHORT}
            self.known = short if len(short) < KNOWN_WORDS // 2 else {"": b""}
        known = self.known
        parts = [_apart(text).replace("\n", " ").split(" ") for text in texts]
        new = [p for p in dict.fromkeys(chain.from_iterable(parts)) if p not in known]
        if new:
            known.update(zip(new, self._encoded(new)))
        for own in parts:
            yield b"".join(map(known.__getitem__, own))
        for p in new:
            if len(p) > LONGEST_KNOWN:
                del known[p]

    def _encoded(self, words: list[str]) -> list[bytes]:
        """Ids of each word. Lower-case Latin-1 letters alone need no more than the tokenizer's model."""
        plain = {w: w for w in words if w.isalpha() and w.isascii() and w.islower()}
        for w in words:
            if w not in plain and w.isalpha() and w.islower() and max(w) < "\u0100":
                plain[w] = w.encode().decode("latin-1").translate(BYTE_LETTERS)
        tokenize = self.model.tokenize
        lists = [[t.id for t in tokenize(x)] for x in plain.values()]
        flat = np.array(list(chain.from_iterable(lists)), dtype="<u4").tobytes()
        cuts = [0, *accumulate(4 * len(own) for own in lists)]
        ids = {w: flat[a:b] for w, a, b in zip(plain, cuts, cuts[1:])}
        rest = [w for w in words if w not in plain]
        if rest:
            ids.update(zip(rest, self._encoded_whole(rest)))
        return [ids[w] for w in words]

    def _encoded_whole(self, words: list[str]) -> list[bytes]:
        got = self.tokenizer.encode(" ".join(words), add_special_tokens=False)
        ids = np.array(got.ids, dtype="<u4").tobytes()
        begins = np.fromiter((a for a, _ in got.offsets), dtype=np.int64, count=len(ids) // 4)
        ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1)
        cuts = (4 * np.searchsorted(begins, ends)).tolist()
        return [ids[a:b] for a, b in zip([0, *cuts], cuts)]


def _pieces(batches: Iterator[pa.RecordBatch], path: str, capacity: int) -> Iterator[pa.RecordBatch]:
    encode, seen = WordEncoder(path), np.zeros(capacity + 1, dtype=np.int64)
    part = TaskContext.get().partitionId()
    end = np.array([END], dtype="<u4").tobytes()
    gc.disable()  # no cycles arise here, and the remembered words would be traversed again and again; other tasks of this worker need it
    try:
        for batch in batches:
            out: list[tuple] = []
            texts = [t.as_py() or "" for t in batch.column(1)]
            encoded = chain.from_iterable(encode(texts[a:b]) for a, b in chunks(texts))
            for doc, ids in zip(batch.column(0).to_pylist(), encoded):
                ids += end
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    own = ids[at : at + 4 * capacity]
                    n = len(own) // 4
                    out.append((doc, k, at // 4, n, zlib.crc32(own), part, int(seen[n])))
                    seen[n] += 1
            names = [c.split()[0] for c in PIECES.split(", ")]
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
            columns = list(zip(*out)) or [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)
    finally:
        gc.enable()


# --- the plan, on the histogram ---------------------------------------------------------------


def _best_pattern(sizes: list[int], values: np.ndarray, limits: list[int], capacity: int) -> tuple[float, np.ndarray]:
    """The most valuable multiset of sizes that fits, by number of items; ``limits`` bounds each count."""
    layers = capacity // min(sizes)
    best, choice = np.zeros(capacity + 1), []
    for _ in range(layers):
        grown, which = best.copy(), np.full(capacity + 1, -1, dtype=np.int32)
        for g, s in enumerate(sizes):
            if values[g] <= 1e-12 or limits[g] < 1:
                continue
            with_it = best[: capacity + 1 - s] + values[g]
            better = with_it > grown[s:] + 1e-12
            grown[s:][better] = with_it[better]
            which[s:][better] = g
        if np.array_equal(grown, best):
            break
        choice.append(which)
        best = grown
    counts, room = np.zeros(len(sizes), dtype=np.int64), capacity
    for which in reversed(choice):
        if which[room] >= 0:
            counts[which[room]] += 1
            room -= sizes[which[room]]
    return float(best[capacity]), np.minimum(counts, limits)


def few_size_patterns(sizes: list[int], demands: list[int], capacity: int, rounds: int = 2000) -> list[tuple[np.ndarray, int]]:
    """Patterns and how often each is used, so that every demand is met.

    Column generation: the linear programme over patterns is solved by the revised simplex method,
    new patterns come from a knapsack over the dual values. Its solution is rounded down; what is
    left, fewer items than sizes times a pattern's length, is packed pattern by pattern.
    """
    k = len(sizes)
    need = np.array(demands, dtype=float)
    basis = np.diag([float(capacity // s) for s in sizes])
    unbounded = [capacity] * k
    for _ in range(rounds):
        inverse = np.linalg.inv(basis)
        amounts, duals = inverse @ need, inverse.sum(axis=0)
        value, pattern = _best_pattern(sizes, duals, unbounded, capacity)
        if value <= 1 + OPTIMAL:
            break
        step = inverse @ pattern
        usable = step > 1e-9
        if not usable.any():
            break
        ratios = np.full(k, np.inf)
        ratios[usable] = np.maximum(amounts[usable], 0) / step[usable]
        basis[:, int(np.argmin(ratios))] = pattern
    amounts = np.floor(np.maximum(np.linalg.solve(basis, need), 0) + 1e-9).astype(np.int64)
    chosen = [(basis[:, j].astype(np.int64), int(amounts[j])) for j in range(k) if amounts[j]]
    left = np.array(demands, dtype=np.int64) - sum((p * n for p, n in chosen), np.zeros(k, dtype=np.int64))
    left = np.maximum(left, 0)
    while left.any():
        _, pattern = _best_pattern(sizes, np.array(sizes, dtype=float) * (left > 0), left.tolist(), capacity)
        times = int(min(left[g] // pattern[g] for g in range(k) if pattern[g]))
        chosen.append((pattern, times))
        left -= pattern * times
    return chosen


class Plan:
    """Which ranks of each length go where; blocks are runs of sequences with the same room left."""

    def __init__(self, capacity: int):
        self.capacity, self.sequences = capacity, 0
        self.rows: list[tuple[int, int, int, int, int]] = []  # length, first rank, how many, first sequence, offset
        self.used = [0] * (capacity + 1)
        self.blocks: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]  # by room: first sequence, how many

    def open(self, n: int) -> int:
        self.sequences += n
        return self.sequences - n

    def place(self, length: int, n: int, sequence: int, offset: int) -> None:
        self.rows.append((length, self.used[length], n, sequence, offset))
        self.used[length] += n

    def large(self, counts: np.ndarray, groups: int) -> None:
        """Linear grouping of the lengths in ``counts``, patterns over the groups, real lengths put in."""
        lengths = [length for length in range(self.capacity, 0, -1) if counts[length]]
        total = int(counts.sum())
        if not total:
            return
        bounds = sorted({total * g // groups for g in range(groups + 1)})
        ends = np.cumsum([counts[length] for length in lengths])
        sizes = [lengths[int(np.searchsorted(ends, a, side="right"))] for a in bounds[:-1]]
        patterns = few_size_patterns(sizes, [b - a for a, b in zip(bounds, bounds[1:])], self.capacity)
        at = bounds[:-1]
        at = list(at)
        for pattern, times in patterns:
            first, slots = self.open(times), []
            for g in np.flatnonzero(pattern):
                for _ in range(int(pattern[g])):
                    n = min(times, bounds[g + 1] - at[g])
                    slots.append((at[g], n))
                    at[g] += n
            # Cut the run of sequences wherever the length in a slot changes or its pieces end.
            cuts = {0, times}
            for start, n in slots:
                cuts.add(n)
                cuts.update(int(e) - start for e in ends[np.searchsorted(ends, start, side="right") : np.searchsorted(ends, start + n)])
            marks = sorted(c for c in cuts if 0 <= c <= times)
            for a, b in zip(marks, marks[1:]):
                offset = 0
                for start, n in slots:
                    if a < n:
                        length = lengths[int(np.searchsorted(ends, start + a, side="right"))]
                        rank = start + a - int(ends[lengths.index(length)] - counts[length])
                        self.rows.append((length, rank, b - a, first + a, offset))
                        offset += length
                self.blocks[self.capacity - offset].append((first + a, b - a))
        for length in lengths:
            self.used[length] = int(counts[length])

    def small(self, counts: np.ndarray) -> None:
        """Best fit, longest first: each length goes to the sequences with the least room that takes it."""
        for length in range(self.capacity, 0, -1):
            left = int(counts[length])
            room = length
            while left:
                while room <= self.capacity and not self.blocks[room]:
                    room += 1
                if room > self.capacity:
                    n = -(-left // (self.capacity // length))
                    self.blocks[self.capacity].append((self.open(n), n))
                    room = self.capacity
                    continue
                first, n = self.blocks[room].pop()
                each = room // length  # after the first piece this sequence fits best again
                if left < n * each:
                    whole = left // each
                    rest = left - whole * each
                    if rest:
                        self._fill(first + whole, 1, room, length, rest)
                    if n > whole + bool(rest):
                        self.blocks[room].append((first + whole + bool(rest), n - whole - bool(rest)))
                    n = whole
                    left -= rest
                if n:
                    self._fill(first, n, room, length, each)
                    left -= n * each

    def _fill(self, first: int, n: int, room: int, length: int, each: int) -> None:
        for k in range(each):
            self.place(length, n, first, self.capacity - room + k * length)
        self.blocks[room - each * length].append((first, n))


def plan(histogram: dict[int, int], capacity: int = CAPACITY, groups: int = GROUPS) -> np.ndarray:
    """Rows of length, first rank, count, first sequence and offset, sorted by length and rank.

    Patterns for the large lengths and best fit for the small, or best fit for all where that needs fewer sequences.
    """
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in histogram.items():
        counts[length] = n
    large = counts.copy()
    large[: capacity // LARGE + 1] = 0
    whole = int(large[capacity])
    large[capacity] = 0
    made = Plan(capacity)
    if whole:
        made.place(capacity, whole, made.open(whole), 0)
    made.large(large, groups)
    small = counts.copy()
    small[capacity // LARGE + 1 :] = 0
    made.small(small)
    plain = Plan(capacity)
    plain.small(counts)
    if plain.sequences < made.sequences:
        made = plain
    rows = np.array(sorted(made.rows), dtype=np.int64).reshape(-1, 5)
    return rows


RANK_BITS = 48


def _placed(batches: Iterator[pa.RecordBatch], rows: np.ndarray) -> Iterator[pa.RecordBatch]:
    starts = (rows[:, 0] << RANK_BITS) + rows[:, 1]
    for batch in batches:
        length, rank = (batch.column(n).to_numpy(zero_copy_only=False) for n in ("length", "rank"))
        at = np.searchsorted(starts, (length << RANK_BITS) + rank, side="right") - 1
        sequence = rows[at, 3] + rank - rows[at, 1]
        kept = [n for n in batch.schema.names if n != "rank"]
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(n) for n in kept], pa.array(sequence), pa.array(rows[at, 4])], [*kept, "sequence_id", "offset"]
        )


def best_fit_packing(
    docs: DataFrame,
    tokenizer: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    capacity: int = CAPACITY,
    groups: int = GROUPS,
) -> DataFrame:
    """Every piece of every document with its sequence and its place there.

    A document is its ids and the id ``END``; null and empty texts are that id alone. Only longer
    documents are cut, every ``capacity`` ids. Result: doc_id, piece, start, length, ids_crc32,
    sequence_id, offset; pieces of a sequence follow each other without a gap from 0. Rows that
    share an id, null ids too, are documents of their own. Other columns are not used.
    """
    spark = docs.sparkSession
    small_batches(spark)
    own = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    # Written, since a piece is known by its task's number and its place among that task's pieces.
    pieces = written(own.mapInArrow(partial(_pieces, path=tokenizer, capacity=capacity), PIECES), "pieces")
    per_part = pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
    # A window over counts: one row per task in each.
    before = F.sum("n").over(Window.partitionBy("length").orderBy("part")) - F.col("n")
    offsets = per_part.select("length", "part", before.alias("before"), "n")
    # At most ``capacity`` rows.
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    rows = plan(histogram, capacity, groups)
    ranked = pieces.join(offsets.drop("n"), ["length", "part"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("nth")).alias("rank")
    )
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return ranked.mapInArrow(partial(_placed, rows=rows), schema)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit_packing(table(spark, sf_dir, "documents"), default_tokenizer())


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return best_fit_packing(docs, default_tokenizer())
