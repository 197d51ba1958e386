"""Removal of long repeated byte strings, by sorting sampled suffixes over the whole corpus.

Every string of ``LENGTH`` bytes has an anchor, the least of its first ``REACH`` byte grams, at the
same place wherever the string occurs. So of all suffixes only those that begin at anchors are
sorted, about one in ``REACH`` / 2. A suffix is compared by tokens: the hash of its ``SHORT`` leading bytes,
which tells of repeats that are too short to be removed, then 32 bits for its leading bytes as far as each string
of that anchor has them whole, and 96 bits that stand for all the strings it anchors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesloom.llm.common import release, small_batches, spread_out, table, written
from salesloom.llm.shingles import chunks, mixed, powers

LENGTH = 400
REACH = 200  # gram positions an anchor is chosen from
SHORT = 150  # bytes, about 25 words; every string of REACH + SHORT - 1 bytes has so many from an anchor on
GRAM = 16  # bytes, SHORT at most; REACH + SHORT - 1 may not exceed LENGTH
LEAD = LENGTH - REACH + 1  # bytes from its anchor on that each string has whole
BASES = (0x100000001B3, 0x9E3779B97F4A7C15)
INVERSES = tuple(pow(b, -1, 1 << 64) for b in BASES)
# Where a suffix begins and which strings it stands for are one number: see ``_span``.
SUFFIX = "t0 long, t1 long, t2 long, id long, key long, span long"
NAMES = [c.split()[0] for c in SUFFIX.split(", ")]
TYPES = [pa.int64()] * 6


def _span(at: np.ndarray, lo: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The place of a suffix, how far before it the first of its strings starts, and how many strings it has."""
    return (at.astype(np.int64) << 32) | ((at - lo).astype(np.int64) << 16) | n.astype(np.int64)


def _with_strings(found: DataFrame) -> DataFrame:
    """``span`` as ``lo`` and ``hi``, the first and the last start of its strings; without strings ``hi`` is below ``lo``."""
    lo = F.shiftright("span", 32) - F.shiftright("span", 16).bitwiseAND(F.lit(0xFFFF))
    return found.withColumn("lo", lo.cast("int")).withColumn("hi", (F.col("lo") + F.col("span").bitwiseAND(F.lit(0xFFFF)) - 1).cast("int"))


class Hashes:
    """Hashes of any byte ranges of one buffer, two of 64 bits."""

    def __init__(self, data: np.ndarray):
        wide = data.astype(np.uint64) + np.uint64(1)
        self.sums = []
        for base in BASES:
            total = np.zeros(len(data) + 1, dtype=np.uint64)
            np.cumsum(wide * powers(base, len(data))[: len(data)], out=total[1:])
            self.sums.append(total)
        self.inverses = [powers(i, len(data)) for i in INVERSES]

    def __call__(self, which: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[which][end] - self.sums[which][start]) * self.inverses[which][start])


def anchors(grams: np.ndarray, reach: int) -> np.ndarray:
    """For every position the first of the least values among it and the ``reach`` - 1 next ones."""
    value, where, width = grams, np.arange(len(grams), dtype=np.int32), 1
    while width < reach:
        step = min(width, reach - width)
        left, right = value[:-step], value[step:]
        where = np.where(left <= right, where[:-step], where[step:])
        value = np.minimum(left, right)
        width += step
    return where


def _texts(batch: pa.RecordBatch) -> list[bytes]:
    return [(t.as_py() or "").encode() for t in batch.column("text")]


def _anchored(grams: np.ndarray, sizes: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchors of texts that stand one after another, the text of each, and the first and the last start of the
    strings of ``REACH`` + ``SHORT`` - 1 bytes that have it. A shorter text of ``SHORT`` bytes has one anchor."""
    size = REACH + SHORT - 1
    where = anchors(grams, REACH)
    owner = np.repeat(np.arange(len(sizes)), sizes)[: max(0, int(begin[-1]) - size + 1)]
    # Strings that lie within one text.
    starts = np.flatnonzero(np.arange(len(owner)) + size <= begin[owner + 1])
    anchor, owner = where[starts], owner[starts]
    new = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1])]))[: len(starts)]
    lo, hi = starts[new], starts[np.concatenate([new[1:], [len(starts)]]).astype(np.int64)[: len(new)] - 1]
    short = np.flatnonzero((sizes >= SHORT) & (sizes < size))
    at = np.array([begin[k] + grams[begin[k] : begin[k + 1] - SHORT + 1].argmin() for k in short], dtype=np.int64)
    columns = ((anchor[new], at), (owner[new], short), (lo, begin[short]), (hi, begin[short]))
    return tuple(np.concatenate(c).astype(np.int64) for c in columns)


def _suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = _texts(batch)
        ids, keys = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("id", "key"))
        for a, b in chunks(texts):
            sizes = np.array([len(t) for t in texts[a:b]])
            if sizes.max() < SHORT:
                continue
            data = np.frombuffer(b"".join(texts[a:b]), dtype=np.uint8)
            hashes, begin = Hashes(data), np.concatenate([[0], np.cumsum(sizes)])
            at = np.arange(len(data) - GRAM + 1)
            m, doc, lo, hi = _anchored((hashes(0, at, at + GRAM) >> np.uint64(32)).astype(np.uint32), sizes, begin)
            n = np.maximum(0, np.minimum(hi, begin[doc + 1] - LENGTH) - lo + 1)
            t0 = hashes(0, m, m + SHORT)
            t1, t2 = (np.zeros(len(m), np.uint64) for _ in range(2))
            own = np.flatnonzero(n)
            p, q, k = m[own], lo[own], n[own]
            # What an anchor's strings are follows from their bytes and where the anchor is among them.
            shape = mixed(((p - q).astype(np.uint64) << np.uint64(32)) + k.astype(np.uint64))
            h1, h2 = (mixed(hashes(which, q, q + k - 1 + LENGTH) ^ shape) for which in (0, 1))
            t1[own] = (hashes(0, p, p + LEAD) >> np.uint64(32) << np.uint64(32)) | (h1 >> np.uint64(32))
            t2[own] = h2
            base = begin[doc]
            columns = [t0.view(np.int64), t1.view(np.int64), t2.view(np.int64), ids[a:b][doc], keys[a:b][doc], _span(m - base, lo - base, n)]
            yield pa.RecordBatch.from_arrays([pa.array(c).cast(t) for c, t in zip(columns, TYPES)], NAMES)


def multikey_order(columns: list[np.ndarray]) -> np.ndarray:
    """Order by the first column, and only within its ties by the next, and so on."""
    order = np.argsort(columns[0], kind="stable")
    group = np.concatenate([[0], np.cumsum(columns[0][order][1:] != columns[0][order][:-1])]) if len(order) else order
    for column in columns[1:]:
        size = np.bincount(group) if len(group) else group
        tied = np.flatnonzero(size[group] > 1)
        if not len(tied):
            break
        own, value = group[tied], column[order[tied]]
        new = np.lexsort((value, own))
        order[tied] = order[tied[new]]
        value = column[order]
        group = np.concatenate([[0], np.cumsum((group[1:] != group[:-1]) | (value[1:] != value[:-1]))])
    return order


MARKED = f"{SUFFIX}, twice boolean, several boolean, shared boolean, part int, ends array<long>"


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One range of suffixes, sorted: those equal to a neighbour (``twice``) or in the first token alone (``shared``),
    those of a run of equal leading bytes with ``several`` kinds, and all of the first and last run, which may go on beyond the range.

    A run has equal first tokens and upper halves of the second. One more row tells the ends of the range.
    """
    got = [b for b in batches if b.num_rows]
    if not got:
        return
    columns = [np.concatenate([b.column(n).to_numpy() for b in got]) for n in NAMES]
    order = multikey_order(columns)
    columns = [c[order] for c in columns]
    t0, t1, t2, id_, key, at = columns
    same_kind = (t0[1:] == t0[:-1]) & (t1[1:] == t1[:-1]) & (t2[1:] == t2[:-1])
    # A row that came twice is one suffix.
    fresh = np.concatenate([[True], ~(same_kind & (id_[1:] == id_[:-1]) & (key[1:] == key[:-1]) & (at[1:] == at[:-1]))])
    columns = [c[fresh] for c in columns]
    t0, t1, t2 = columns[:3]
    same_kind = (t0[1:] == t0[:-1]) & (t1[1:] == t1[:-1]) & (t2[1:] == t2[:-1])
    twice = np.concatenate([[False], same_kind]) | np.concatenate([same_kind, [False]])
    same_start, lead = t0[1:] == t0[:-1], t1 >> 32
    shared = np.concatenate([[False], same_start]) | np.concatenate([same_start, [False]])
    first = np.flatnonzero(np.concatenate([[True], ~same_start | (lead[1:] != lead[:-1])]))
    last = np.concatenate([first[1:], [len(t0)]]) - 1
    run = np.repeat(np.arange(len(first)), last - first + 1)
    several = ((t1[first] != t1[last]) | (t2[first] != t2[last]))[run]
    wanted = np.flatnonzero(shared | (run == 0) | (run == len(first) - 1))
    part = TaskContext.get().partitionId()
    ends = [int(c[k]) for k in (0, last[0], first[-1], len(t0) - 1) for c in (t0, t1, t2)]
    n = len(wanted)
    names = [*NAMES, "twice", "several", "shared", "part", "ends"]
    kind = pa.list_(pa.int64())
    for a in range(0, n, 65536):
        own = wanted[a : a + 65536]
        rows = [pa.array(c[own]).cast(t) for c, t in zip(columns, TYPES)]
        flags = [*[pa.array(f[own]) for f in (twice, several, shared)], pa.array(np.full(len(own), part, np.int32))]
        yield pa.RecordBatch.from_arrays([*rows, *flags, pa.nulls(len(own), kind)], names)
    blank = [pa.nulls(1, t) for t in TYPES]
    yield pa.RecordBatch.from_arrays(
        [*blank, *[pa.nulls(1, pa.bool_())] * 3, pa.array([part], pa.int32()), pa.array([ends], kind)], names
    )


BOUNDS = "of int, before array<long>, after array<long>, first array<long>, first_several boolean, last array<long>, last_several boolean"


def across_boundaries(ends: list[tuple[int, list[int]]]) -> list[tuple]:
    """What each range needs to know of its neighbours, from the ends of all ranges in order.

    ``ends``: number of the range; leading tokens and kind (three numbers each) of its first suffix,
    of the last of its first run, of the first of its last run, and of its last suffix.
    """
    out, runs = [], []
    for k, (part, e) in enumerate(ends):
        first, first_end, last_begin, last = (tuple(e[i : i + 3]) for i in (0, 3, 6, 9))
        begin, end = _run(first), _run(last)
        goes_on = runs and runs[-1]["run"] == begin
        if not goes_on:
            runs.append({"run": begin, "begin": first})
        runs[-1]["end"] = first_end
        own = len(runs) - 1
        if end != begin:
            runs.append({"run": end, "begin": last_begin, "end": last})
        before = list(ends[k - 1][1][9:12]) if k else None
        after = list(ends[k + 1][1][0:3]) if k + 1 < len(ends) else None
        out.append((part, before, after, begin, own, end, len(runs) - 1))
    several = [r["begin"] != r["end"] for r in runs]
    return [(p, b, a, f, several[x], l, several[y]) for p, b, a, f, x, l, y in out]


def _run(suffix: tuple[int, int, int]) -> list[int]:
    """The first token and the upper half of the second."""
    return [suffix[0], suffix[1] >> 32]


def repeated(suffixes: DataFrame, name: str) -> DataFrame:
    """The suffixes whose first token stands elsewhere too: ``twice`` if all their strings do, ``several`` if
    others with the same leading bytes differ.

    Spark samples splitters and deals out ranges of suffixes; for the sample it computes them a
    second time, which costs less than a written copy. A range is cut within equal suffixes
    too, by document and place, so that one that fills a third of the corpus is many tasks' work.
    """
    ranged = suffixes.repartitionByRange(*NAMES)
    marked = written(ranged.mapInArrow(_compared, MARKED), f"{name}-sorted")
    # One row per range.
    ends = sorted((r["part"], r["ends"]) for r in marked.filter("ends IS NOT NULL").select("part", "ends").collect())
    bounds = suffixes.sparkSession.createDataFrame(across_boundaries(ends), BOUNDS)
    found = marked.filter("ends IS NULL").join(F.broadcast(bounds), F.col("part") == F.col("of"))
    kind = F.array("t0", "t1", "t2")
    twice = F.col("twice") | F.coalesce(kind == F.col("before"), F.lit(False)) | F.coalesce(kind == F.col("after"), F.lit(False))
    run = F.array("t0", F.shiftright("t1", 32))
    several = F.col("several") | ((run == F.col("first")) & F.col("first_several")) | ((run == F.col("last")) & F.col("last_several"))
    beyond = [F.coalesce(F.col("t0") == F.get(side, F.lit(0)), F.lit(False)) for side in ("before", "after")]
    shared = F.col("shared") | beyond[0] | beyond[1]
    return _with_strings(found.filter(shared).select(*NAMES, twice.alias("twice"), several.alias("several")))


def _strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every string of the wanted anchors, one row each, in the form of a suffix of its own."""
    for batch in batches:
        for text, id_, key, spans in zip(_texts(batch), batch.column("id"), batch.column("key"), batch.column("spans").to_pylist()):
            hashes = Hashes(np.frombuffer(text, dtype=np.uint8))
            at = np.concatenate([np.arange(s["lo"], s["hi"] + 1) for s in spans])
            h1, h2 = (hashes(k, at, at + LENGTH).view(np.int64) for k in (0, 1))
            columns = [h1, h2, np.zeros(len(at), np.int64), np.full(len(at), id_.as_py()), np.full(len(at), key.as_py()), _span(at, at, np.ones(len(at)))]
            yield pa.RecordBatch.from_arrays([pa.array(c).cast(t) for c, t in zip(columns, TYPES)], NAMES)


CUT = "id long, none boolean, n_shared long, n_bytes long, n_removed long, spans array<struct<start:long,end:long>>, kept binary"


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    for batch in batches:
        texts, sizes, removed, spans, kept = _texts(batch), [], [], [], []
        for text, found in zip(texts, batch.column("found")):
            data = np.frombuffer(text, dtype=np.uint8)
            sizes.append(len(data))
            if not found.is_valid:
                removed.append(0), spans.append([]), kept.append(text)
                continue
            lo, hi = (found.values.field(k).to_numpy() for k in ("lo", "hi"))
            steps = np.bincount(lo, minlength=len(data) + 1) - np.bincount(hi + LENGTH, minlength=len(data) + 1)
            gone = np.cumsum(steps)[:-1] > 0
            edges = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8)))
            removed.append(int(gone.sum()))
            spans.append([{"start": int(s), "end": int(e)} for s, e in zip(edges[::2], edges[1::2])])
            kept.append(data[~gone].tobytes())
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("id"),
                batch.column("none"),
                batch.column("n_shared"),
                pa.array(sizes, pa.int64()),
                pa.array(removed, pa.int64()),
                pa.array(spans, span),
                pa.array(kept, pa.binary()),
            ],
            ["id", "none", "n_shared", "n_bytes", "n_removed", "spans", "kept"],
        )


def substring_dedup(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Every document without the bytes that a string of ``LENGTH`` bytes covers which also starts elsewhere.

    Texts are UTF-8 bytes, null is empty; strings lie within one document, may overlap each other
    and are judged on the input. Result: id, ``n_bytes``, ``n_removed``, ``spans`` (removed runs,
    start and end), ``kept`` (the other bytes, which may cut a character), and ``n_shared``: the anchors whose
    leading ``SHORT`` bytes stand elsewhere too, which tells of repeated passages that are too short to be removed, every
    one of ``REACH + SHORT - 1`` bytes among them. Rows equal in id and text are one document and come back each. Other columns are not used.
    """
    spark = docs.sparkSession
    spread_out(spark)
    small_batches(spark)
    # The key tells texts of one id apart, and a missing id from 0.
    key = F.xxhash64(F.coalesce(F.col(text_column), F.lit("")), F.col(id_column).isNull())
    own = docs.select(
        F.coalesce(F.col(id_column).cast("long"), F.lit(0).cast("long")).alias("id"),
        key.alias("key"),
        F.col(text_column).alias("text"),
        F.col(id_column).isNull().alias("none"),
    )
    texts = own.select("id", "key", "text")
    # Read from the sorted ranges each time: a copy would cost more disk than its few reads cost time.
    found = repeated(texts.mapInArrow(_suffixes, SUFFIX), "suffixes")
    release(spark)
    whole = found.filter("twice AND lo <= hi").select("id", "key", "lo", "hi")
    # Where suffixes agree in the leading bytes only, their strings are compared one by one, of one
    # suffix of each kind; all strings of a kind that occurs twice are known to repeat, so only
    # the leading bytes of some kind that is alone matter.
    kinds = found.filter("several AND lo <= hi").groupBy("t0", "t1", "t2").agg(
        F.min(F.struct("id", "key", "lo", "hi")).alias("one"), F.min("twice").alias("twice")
    )
    kinds = written(kinds.withColumn("lead", F.shiftright("t1", 32)), "kinds")
    alone = written(kinds.filter("NOT twice").select("t0", "lead").distinct(), "alone")
    wanted = kinds.join(alone, ["t0", "lead"], "left_semi").select("one.*").groupBy("id", "key").agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))
    strings = texts.join(wanted, ["id", "key"]).mapInArrow(_strings, SUFFIX)
    part = repeated(strings, "strings").filter("twice").select("id", "key", "lo", "hi")
    part = written(part, "repeated-strings")
    release(spark)
    spans = whole.unionByName(part).groupBy("id", "key").agg(F.collect_list(F.struct("lo", "hi")).alias("found"))
    shared = found.groupBy("id", "key").agg(F.count_distinct("span").alias("n_shared"))
    marks = shared.join(spans, ["id", "key"], "left")
    n_shared = F.coalesce("n_shared", F.lit(0).cast("long")).alias("n_shared")
    cut = own.join(marks, ["id", "key"], "left").select("id", "none", n_shared, "text", "found").mapInArrow(_cut, CUT)
    return cut.select(F.when(~F.col("none"), F.col("id")).alias(id_column), "n_bytes", "n_removed", "spans", "kept", "n_shared")


def op3_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_bytes",
        "n_removed",
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
        "n_shared",
    )
