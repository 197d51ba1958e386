"""Removal of paragraphs that repeat, exactly or nearly, anywhere in the corpus: MinHash bands and exact check.

Passages that fill no paragraph are found by windows of words that begin at anchors: an anchor is the
least of ``REACH`` word grams in a row, wherever they stand, so copies have theirs at the same words.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesloom.llm.common import small_batches, spread_out, table, text_key, written
from salesloom.llm.components import FEW_LINKS, components
from salesloom.llm.shingles import THRESHOLD, MinHash, chunks, mixed, set_id, shingle_sets, shingles_of, word_edges, word_hashes
from salesloom.llm.suffix_dedup import anchors
from salesloom.llm.verify import blocked, bucket_links, link_groups, narrowed, verified_links, with_sets

MIN_WORDS = 25  # shorter paragraphs take part together with their neighbours
MOST = 4  # times MIN_WORDS: a block of short paragraphs ends there at the latest
RECALL = 0.9998  # of pairs of paragraphs at the threshold
VALUES = 64  # MinHash values a paragraph may cost
REACH = 26  # places an anchor is chosen from: every string of REACH + MIN_WORDS - 1 words has a whole window
GRAM = 5  # words that decide between places


def tuned_bands(similarity: float, recall: float, values: int) -> tuple[int, int]:
    """Bands and rows: the most rows a band, which is the fewest false candidates, that reach ``recall``."""
    for rows in range(16, 0, -1):
        for bands in range(1, values // rows + 1):
            if 1 - (1 - similarity**rows) ** bands >= recall:
                return bands, rows
    raise ValueError(f"{values} values do not reach a recall of {recall}")


def _chance(similarity, bands: int, rows: int):
    return 1 - (1 - similarity**rows) ** bands


def _units(lines: list[bytes], counts: list[int], min_words: int) -> list[tuple[int, int]]:
    """First and last line of what is compared as one: a line of ``min_words`` words, a block of shorter ones, a short text.

    A block ends, once it has ``min_words`` words, before a line without words or after a line that its
    own hash names, so that copies are cut alike; what is too short at the end of a run joins the block before.
    """
    filled = [k for k, n in enumerate(counts) if n]
    if sum(counts) < min_words:
        return [(filled[0], filled[-1])] if filled else []
    units: list[tuple[int, int]] = []
    run: list[list] = []  # the blocks of a run of short lines: first, last, words, ended
    for k, n in enumerate([*counts, min_words]):
        if n >= min_words:
            if len(run) > 1 and run[-1][2] < min_words:
                tail = run.pop()
                run[-1][1] = tail[1]
            units += [(first, last) for first, last, words, _ in run if words >= min_words]
            run = []
            units += [(k, k)] if k < len(counts) else []
        elif n:
            if not run or run[-1][3]:
                run.append([k, k, 0, False])
            block = run[-1]
            block[1], block[2] = k, block[2] + n
            block[3] = block[2] >= min_words and (zlib.crc32(lines[k]) % 2 == 0 or block[2] >= MOST * min_words)
        elif run:
            run[-1][3] = run[-1][2] >= min_words
    return units


def _hashed(texts: list[str | None]) -> Iterator[tuple[int, list[list[bytes]], np.ndarray, np.ndarray, np.ndarray]]:
    """Of each run of texts its first number, their lines, the words of each line, the first words of the texts and the end of all, and the hashes of all words."""
    data = [(t or "").encode() for t in texts]
    for a, b in chunks(data):
        split = [d.split(b"\n") for d in data[a:b]]
        hashes, owner = word_hashes([line for lines in split for line in lines])
        counts = np.bincount(owner, minlength=sum(map(len, split)))
        begin = np.concatenate([[0], np.cumsum(counts)])[np.cumsum([0, *map(len, split)])]
        yield a, split, counts, begin, hashes


def _lines(read: list[tuple]) -> Iterator[tuple[int, list[bytes], np.ndarray, np.ndarray]]:
    """Of each text its number, its lines, the words of each line, and the hashes of all words."""
    for a, split, counts, begin, hashes in read:
        line = 0
        for k, lines in enumerate(split):
            yield a + k, lines, counts[line : line + len(lines)], hashes[begin[k] : begin[k + 1]]
            line += len(lines)


def _listed(values: np.ndarray, sizes: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    """Lists of the given sizes, one after another in ``values``."""
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(values, kind))


def _marker(bands: int, rows: int, min_words: int) -> Callable[[pa.RecordBatch, list[tuple]], pa.RecordBatch]:
    minhash = MinHash(bands * rows, seed=2)
    weights = (2 * np.arange(rows, dtype=np.uint64) + np.uint64(3)) * np.uint64(0x9E3779B97F4A7C15) | np.uint64(1)
    salts = mixed(np.arange(1, bands + 1, dtype=np.uint64))

    def marked(batch: pa.RecordBatch, read: list[tuple]) -> pa.RecordBatch:
        words, runs, places, n = [np.empty(0, np.uint64)], [], [], 0
        for k, lines, counts, hashes in _lines(read):
            ends = (n + np.cumsum(counts)).tolist()
            for at, to in _units(lines, counts.tolist(), min_words):
                runs.append((ends[at - 1] if at else n, ends[to]))
                places.append((k, at, to))
            words.append(hashes)
            n += len(hashes)
        sets = shingles_of(np.concatenate(words), runs)
        values = minhash.many(sets).astype(np.uint64).reshape(len(sets), bands, rows)
        keys = mixed((values * weights).sum(axis=2, dtype=np.uint64) ^ salts).view(np.int64)
        columns = list(zip(*places)) or [[]] * 3
        owner = pa.array(columns[0], pa.int64())
        return pa.RecordBatch.from_arrays(
            [
                batch.column("id").take(owner),
                batch.column("key").take(owner),
                pa.array(columns[1], pa.int32()),
                pa.array(columns[2], pa.int32()),
                pa.array([set_id(s) for s in sets], pa.binary()),
                pa.array([len(s) for s in sets], pa.int64()),
                _listed(keys.ravel(), np.full(len(sets), bands), pa.int64()),
            ],
            ["id", "key", "at", "to", "cls", "n", "bands"],
        )

    return marked


def _banded(batches: Iterator[pa.RecordBatch], bands: int, rows: int, min_words: int) -> Iterator[pa.RecordBatch]:
    marked = _marker(bands, rows, min_words)
    for batch in batches:
        yield marked(batch, list(_hashed(batch.column("text").to_pylist())))


def _edge_windows(batch: pa.RecordBatch, read: list[tuple], min_words: int) -> pa.RecordBatch:
    out: list[tuple] = []
    for k, _, counts, hashes in _lines(read):
        filled = np.flatnonzero(counts)
        ends = np.cumsum(counts)[filled]
        starts = ends - counts[filled]
        short = counts[filled] < min_words
        begins = np.unique(np.concatenate([starts[short], ends[short] - min_words]))
        begins = begins[(begins >= 0) & (begins + min_words <= len(hashes))]
        low = filled[np.searchsorted(starts, begins)]
        high = filled[np.searchsorted(ends, begins + min_words, side="right") - 1]
        for at, a, b in zip(begins.tolist(), low.tolist(), high.tolist()):
            out.append((k, at, a, b, hashlib.blake2b(hashes[at : at + min_words].tobytes(), digest_size=16).digest()))
    columns = list(zip(*out)) or [[]] * 5
    owner = pa.array(columns[0], pa.int64())
    return pa.RecordBatch.from_arrays(
        [
            batch.column("id").take(owner),
            batch.column("key").take(owner),
            pa.array(columns[1], pa.int64()),
            pa.array(columns[2], pa.int32()),
            pa.array(columns[3], pa.int32()),
            pa.array(columns[4], pa.binary()),
        ],
        ["id", "key", "word", "at", "to", "cls"],
    )


def _windows(batches: Iterator[pa.RecordBatch], min_words: int) -> Iterator[pa.RecordBatch]:
    """The strings of ``min_words`` words that begin or end with a shorter line, and the lines that each holds whole."""
    for batch in batches:
        yield _edge_windows(batch, list(_hashed(batch.column("text").to_pylist())), min_words)


def _weights(n: int, seed: int) -> np.ndarray:
    return mixed(np.arange(seed * n + 1, seed * n + n + 1, dtype=np.uint64)) | np.uint64(1)


def anchored(hashes: np.ndarray, window: int, reach: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First words of the windows that begin at anchors, and two hashes of each window's words."""
    return anchored_texts(hashes, np.array([0, len(hashes)]), window, reach)


def anchored_texts(hashes: np.ndarray, begin: np.ndarray, window: int, reach: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same of texts whose words stand one after another; ``begin``: their first words and the end of all."""
    gram = min(GRAM, window)
    total = np.zeros(max(0, len(hashes) - gram + 1), dtype=np.uint64)
    for k, w in enumerate(_weights(gram, 0)):
        total += hashes[k : k + len(total)] * w
    total = mixed(total)
    sizes = np.diff(begin)
    # Runs of windows that lie within one text.
    owner = np.repeat(np.arange(len(sizes)), sizes)[: max(0, len(hashes) - reach - window + 2)]
    at = anchors(total, reach)[np.flatnonzero(np.arange(len(owner)) + reach + window - 1 <= begin[owner + 1])]
    at = at[np.flatnonzero(np.diff(at, prepend=-1))]
    short = begin[:-1][(sizes >= window) & (sizes < reach + window - 1)], sizes[(sizes >= window) & (sizes < reach + window - 1)]
    alone = np.array([a + int(total[a : a + n - window + 1].argmin()) for a, n in zip(*map(np.ndarray.tolist, short))], dtype=np.int64)
    at = np.sort(np.concatenate([at, alone])).astype(np.int64)
    words = hashes[at[:, None] + np.arange(window)]
    return at, *(mixed((words * _weights(window, seed)).sum(axis=1, dtype=np.uint64)).view(np.int64) for seed in (1, 2))


def _anchor_windows(batch: pa.RecordBatch, read: list[tuple], window: int, reach: int) -> pa.RecordBatch:
    found, sizes, lines = [[np.empty(0, np.int64)] * 3], [np.empty(0, np.int64)], []
    for _, split, _, begin, hashes in read:
        at, *tokens = anchored_texts(hashes, begin, window, reach)
        own = np.searchsorted(begin, at, side="right") - 1
        found.append([at - begin[own], *tokens])
        sizes.append(np.bincount(own, minlength=len(split)))
        lines += map(len, split)
    kinds = (pa.int32(), pa.int64(), pa.int64())
    arrays = [_listed(np.concatenate(c), np.concatenate(sizes), kind) for c, kind in zip(zip(*found), kinds)]
    return pa.RecordBatch.from_arrays([batch.column("id"), batch.column("key"), pa.array(lines, pa.int64()), *arrays], ["id", "key", "n", "words", "h1", "h2"])


def _anchored(batches: Iterator[pa.RecordBatch], window: int, reach: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield _anchor_windows(batch, list(_hashed(batch.column("text").to_pylist())), window, reach)


PARAGRAPHS = "id long, key long, at int, to int, cls binary, n long, bands array<long>"
WINDOWS = "id long, key long, word long, at int, to int, cls binary"
ANCHORED = "id long, key long, n long, words array<int>, h1 array<long>, h2 array<long>"
SCANNED = "kind int, id long, key long, at int, to int, cls binary, n long, bands array<long>, word long, words array<int>, h1 array<long>, h2 array<long>"
KINDS = {"at": pa.int32(), "to": pa.int32(), "cls": pa.binary(), "n": pa.int64(), "bands": pa.list_(pa.int64()), "word": pa.int64()}
KINDS |= {"words": pa.list_(pa.int32()), "h1": pa.list_(pa.int64()), "h2": pa.list_(pa.int64())}


def _all(batches: Iterator[pa.RecordBatch], bands: int, rows: int, min_words: int, reach: int) -> Iterator[pa.RecordBatch]:
    """Paragraphs (kind 0), windows at edges of short lines (1) and texts with their windows at anchors (2), of words hashed once."""
    marked = _marker(bands, rows, min_words)
    for batch in batches:
        read = list(_hashed(batch.column("text").to_pylist()))
        for kind, part in enumerate((marked(batch, read), _edge_windows(batch, read, min_words), _anchor_windows(batch, read, min_words, reach))):
            own = [part.column(c) if c in part.schema.names else pa.nulls(part.num_rows, t) for c, t in KINDS.items()]
            whole = [pa.array(np.full(part.num_rows, kind, np.int32)), part.column("id"), part.column("key"), *own]
            yield pa.RecordBatch.from_arrays(whole, ["kind", "id", "key", *KINDS])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The shingle sets of the wanted paragraphs of each text."""
    for batch in batches:
        rows, parts = [], []
        for text, wanted in zip(batch.column("text"), batch.column("what").to_pylist()):
            lines = (text.as_py() or "").encode().split(b"\n")
            rows += wanted
            parts += [b"\n".join(lines[w["at"] : w["to"] + 1]) for w in wanted]
        sets = [s.astype("<u8").tobytes() for s in shingle_sets(parts)]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([r["cls"] for r in rows], pa.binary()),
                pa.array([r["root"] for r in rows], pa.binary()),
                pa.array([r["n"] for r in rows], pa.int64()),
                pa.array([r["blocks"] for r in rows], pa.int32()),
                pa.array([r["block"] for r in rows], pa.int32()),
                pa.array([r["pack"] for r in rows], pa.int32()),
                pa.array(sets, pa.binary()),
            ],
            ["cls", "root", "n", "blocks", "block", "pack", "shingles"],
        )


def _own(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    return docs.select(
        F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"), text_key(F.col(text_column)).alias("key")
    )


def repeated_passages(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", min_words: int = MIN_WORDS, scanned: DataFrame | None = None
) -> DataFrame:
    """Lines of fewer than ``min_words`` words in a string of that many that stood before: id, key, at and to (from 0).

    Every short line is looked up with the words after it and with the words before it, whatever
    lines those are in, and each string covers the lines that it holds whole. So every short line
    of a passage of whole lines that repeats is found, if the passage has ``min_words`` words in
    all, and a short line beside a long one as well if the words next to it repeat too. Words count,
    not what stands between them. The first string in the order of id (null last), text key and place stays.
    """
    spark = docs.sparkSession
    spread_out(spark)
    small_batches(spark)
    if scanned is None:
        own = _own(docs, id_column, text_column)
        windows = written(own.mapInArrow(partial(_windows, min_words=min_words), WINDOWS), "passages")
    else:
        windows = scanned.filter("kind = 1").select("id", "key", "word", "at", "to", "cls")
    place = F.struct(F.col("id").isNull().alias("none"), "id", "key", "word")
    leads = windows.groupBy("cls").agg(F.min(place).alias("lead"), F.max(place).alias("final"))
    leads = written(leads.filter("lead <> final").drop("final"), "passage-leads")
    return windows.join(leads, "cls").filter(place != F.col("lead")).select("id", "key", "at", "to")


def repeated_paragraphs(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    min_words: int = MIN_WORDS,
    recall: float = RECALL,
    scanned: DataFrame | None = None,
) -> DataFrame:
    """Paragraphs that repeat an earlier one: id, key (of the text), at and to (first and last line, from 0), group, and the first's id and place.

    A paragraph is a line, what stands between two ``\\n``, of ``min_words`` words or more, a block of
    consecutive shorter lines that reaches as many, or a whole text that does not.
    Paragraphs that share at least ``THRESHOLD`` of their different five-word shingles are linked;
    in each component of links the first in the order of id (null last), text key and place
    stays. Bands are tuned so that a pair at the threshold meets in one with probability ``recall``;
    paragraphs that meet are compared exactly, a class of equal ones once.
    """
    spark = docs.sparkSession
    spread_out(spark)
    small_batches(spark)
    bands, rows = tuned_bands(THRESHOLD[0] / THRESHOLD[1], recall, VALUES)
    own = _own(docs, id_column, text_column)
    if scanned is None:
        marked = written(own.mapInArrow(partial(_banded, bands=bands, rows=rows, min_words=min_words), PARAGRAPHS), "paragraphs")
    else:
        marked = scanned.filter("kind = 0").select("id", "key", "at", "to", "cls", "n", "bands")
    place = F.struct(F.col("id").isNull().alias("none"), "id", "key", "at", "to")
    classes = written(
        marked.groupBy("cls").agg(
            F.min(place).alias("first"), F.max(place).alias("last"), F.first("n").alias("n"), F.first("bands").alias("bands")
        ),
        "paragraph-classes",
    )
    # A band's hash holds its number, so one column tells the bucket.
    at = classes.select("cls", F.explode("bands").alias("bucket"))
    groups = components(bucket_links(at, "buckets"), "paragraph-candidates", FEW_LINKS)
    members = blocked(groups.withColumnRenamed("node", "cls").join(classes.select("cls", "first", "n"), "cls"))
    # A document's wanted paragraphs travel together: its text is read once.
    wanted = members.groupBy("first.id", "first.key").agg(
        F.collect_list(F.struct("cls", "root", "n", "blocks", "block", "pack", F.col("first.at").alias("at"), F.col("first.to").alias("to"))).alias("what")
    )
    schema = "cls binary, root binary, n long, blocks int, block int, pack int, shingles binary"
    links = verified_links(narrowed(with_sets(own, wanted, _sets, schema)), partial(_chance, bands=bands, rows=rows))
    _, linked = link_groups(links, FEW_LINKS)
    summary = classes.select("cls", "first", "last").join(linked.withColumnRenamed("node", "cls"), "cls", "left")
    summary = summary.select("cls", "first", "last", F.coalesce("root", "cls").alias("root"))
    leads = summary.groupBy("root").agg(F.min("first").alias("lead"), F.max("last").alias("final"))
    leads = written(leads.filter("lead <> final").drop("final"), "paragraph-leads")
    doubled = written(summary.join(leads, "root").select("cls", "lead", "root"), "doubled-classes")
    later = marked.drop("bands", "n").join(doubled, "cls").filter(place != F.col("lead"))
    return later.select("id", "key", "at", "to", F.col("root").alias("group"), "lead").distinct()


def shared_passages(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    window: int = MIN_WORDS,
    reach: int = REACH,
    scanned: DataFrame | None = None,
) -> DataFrame:
    """Windows of ``window`` words that stand elsewhere too: id, key, word (the first, from 0), and ``first``, whether none stood before.

    Only windows that begin at anchors are looked at, so every string of ``reach`` + ``window`` - 1 words
    that repeats has one that does, in whatever lines it stands. Words count, not what is between them.
    Hashes of single windows are counted first, and only windows whose hash repeats go on. The order is that of id
    (null last), text key and place; rows equal in id and text are one document.
    """
    spark = docs.sparkSession
    spread_out(spark)
    small_batches(spark)
    if scanned is None:
        own = _own(docs, id_column, text_column).mapInArrow(partial(_anchored, window=window, reach=reach), ANCHORED)
        own = written(own, "anchored-windows")
    else:
        own = scanned.filter("kind = 2")
    own = own.select("id", "key", F.col("words").alias("word"), "h1", "h2")
    often = own.select(F.explode("h1").alias("h1")).groupBy("h1").agg(F.count("*").alias("n")).filter("n > 1").select("h1")
    often = written(often, "repeated-hashes")
    windows = own.select("id", "key", F.inline(F.arrays_zip("word", "h1", "h2")))
    hits = written(windows.join(often, "h1"), "repeated-windows")
    place = F.struct(F.col("id").isNull().alias("none"), "id", "key", "word")
    leads = hits.groupBy("h1", "h2").agg(F.min(place).alias("lead"), F.max(place).alias("final"))
    leads = written(leads.filter("lead <> final").drop("final"), "window-leads")
    return hits.join(leads, ["h1", "h2"]).select("id", "key", "word", (place == F.col("lead")).alias("first")).distinct()


FINDINGS = ("n_paragraphs", "removed", "words", "n_shared")


def scanned_texts(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", min_words: int = MIN_WORDS, recall: float = RECALL
) -> DataFrame:
    """What ``repeated_paragraphs``, ``repeated_passages`` and ``shared_passages`` look at, from one scan of the texts."""
    spark = docs.sparkSession
    small_batches(spark)
    bands, rows = tuned_bands(THRESHOLD[0] / THRESHOLD[1], recall, VALUES)
    scan = partial(_all, bands=bands, rows=rows, min_words=min_words, reach=REACH)
    return written(_own(docs, id_column, text_column).mapInArrow(scan, SCANNED), "scanned-texts")


def _findings(found: DataFrame, scanned: DataFrame, docs: DataFrame, id_column: str, text_column: str, min_words: int, **options) -> DataFrame:
    """The documents of ``found`` (id, key) with what repeats in them."""
    paragraphs = repeated_paragraphs(docs, id_column, text_column, min_words, scanned=scanned, **options)
    later = written(paragraphs, "later-paragraphs")
    gone = later.select("id", "key", "at", "to").unionByName(repeated_passages(docs, id_column, text_column, min_words, scanned))
    line = F.explode(F.sequence("at", "to")).alias("line")
    gone = gone.select("id", "key", line).groupBy("id", "key").agg(F.sort_array(F.collect_set("line")).alias("removed"))
    windows = written(shared_passages(docs, id_column, text_column, min_words, scanned=scanned), "shared-passages")
    leads = later.select("lead.id", "lead.key", "lead.at", "lead.to").distinct()
    shared = later.select("id", "key").unionByName(leads.select("id", "key")).select("id", "key", F.lit(None).cast("int").alias("word"))
    shared = shared.unionByName(windows.select("id", "key", F.when(~F.col("first"), F.col("word")).alias("word")))
    shared = shared.groupBy("id", "key").agg(F.count("*").alias("n_shared"), F.sort_array(F.collect_list("word")).alias("words"))
    for part, names in ((gone, ["removed"]), (shared, ["words", "n_shared"])):
        other = part.select(F.col("id").alias("i"), F.col("key").alias("k"), *names)
        same = F.col("id").eqNullSafe(F.col("i")) & (F.col("key") == F.col("k"))
        found = found.join(other, same, "left").drop("i", "k")
    none = F.array().cast("array<int>")
    return found.withColumns(
        {"removed": F.coalesce("removed", none), "words": F.coalesce("words", none), "n_shared": F.coalesce("n_shared", F.lit(0).cast("long"))}
    )


def findings(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", min_words: int = MIN_WORDS, **options
) -> DataFrame:
    """Every document (id, text, key) with what repeats in it.

    ``n_paragraphs`` (pieces between ``\\n``), ``removed`` (numbers from 0 of the lines to go, sorted), ``words``
    (first words of the windows of ``shared_passages`` that stood before, sorted) and ``n_shared``: its
    paragraphs and windows that stand elsewhere too, also those that stay because they are the first.
    """
    scanned = scanned_texts(docs, id_column, text_column, min_words, **options)
    found = _own(docs, id_column, text_column).withColumn("n_paragraphs", F.size(F.split(F.coalesce("text", F.lit("")), "\n")).cast("long"))
    return _findings(found, scanned, docs, id_column, text_column, min_words, **options)


def without(text: str, removed: list[int], words: list[int], window: int) -> str:
    """The lines that stay, less the words of the windows; a line of which no word is left goes too."""
    data = text.encode()
    starts, ends = word_edges(data)
    gone = np.zeros(len(starts) + 1, dtype=np.int32)
    for w in words:
        gone[w] += 1
        gone[min(w + window, len(starts))] -= 1
    gone = np.cumsum(gone)[:-1] > 0
    out, at, skipped = [], 0, set(removed)
    for k, line in enumerate(data.split(b"\n")):
        end = at + len(line)
        if k not in skipped:
            a, b = np.searchsorted(starts, [at, end])
            inside = gone[a:b]
            if not inside.any():
                out.append(line)
            elif not inside.all():
                kept = np.ones(len(line), dtype=bool)
                for w in np.flatnonzero(inside) + a:
                    # A word goes with what stands between it and the next one.
                    kept[starts[w] - at : (starts[w + 1] if w + 1 < b else end) - at] = False
                out.append(np.frombuffer(line, np.uint8)[kept].tobytes().rstrip(b" "))
        at = end + 1
    return b"\n".join(out).decode()


def _without(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [
            t if t is None or not (r or w) else without(t, r, w, window)
            for t, r, w in zip(*[batch.column(c).to_pylist() for c in ("text", "removed", "words")])
        ]
        names = ["id", *FINDINGS]
        yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], pa.array(texts, pa.string())], [*names, "text"])


def paragraph_dedup(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", min_words: int = MIN_WORDS, **options
) -> DataFrame:
    """Every document with the lines that ``repeated_paragraphs`` and ``repeated_passages`` leave, less later passages inside them.

    Result: id, the columns of ``findings``, and ``text`` (what stays; null stays null). A passage that repeats within longer
    lines goes by whole windows of ``min_words`` words, so some words at its ends may stay. Null and empty texts
    have one empty paragraph. Rows equal in id and text are one document and come back each. Other columns are not used.
    """
    found = findings(docs, id_column, text_column, min_words, **options).select("id", "text", *FINDINGS)
    schema = "id long, n_paragraphs long, removed array<int>, words array<int>, n_shared long, text string"
    return found.mapInArrow(partial(_without, window=min_words), schema).withColumnRenamed("id", id_column)


def op6_paragraph_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scanned = scanned_texts(docs)
    # Without the texts, which the scan has counted the lines of.
    found = scanned.filter("kind = 2").select("id", "key", F.col("n").alias("n_paragraphs"))
    found = _findings(found, scanned, docs, "doc_id", "text", MIN_WORDS)
    return found.select(
        F.col("id").alias("doc_id"), "n_paragraphs", F.size("removed").cast("long").alias("n_removed"), "removed",
        F.size("words").cast("long").alias("n_windows"), "n_shared",
    )
