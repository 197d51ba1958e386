"""Near copies, repeated strings, lines and paragraphs against brute force."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict
from functools import partial
from importlib import import_module

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from salesloom.llm import line_dedup, minhash_forest, paragraph_dedup, suffix_dedup, verify
from salesloom.llm.components import components
from salesloom.llm.shingles import MinHash, set_id, shingle_sets, similar_pairs
from salesloom.llm.suffix_dedup import across_boundaries, anchors, multikey_order
from tests.llm.conftest import sentence

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def distinct_texts(df):
    return {(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()}


def words(text):
    return [w.translate(UPPER) for w in re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text or "")]


def shingles(text):
    w = words(text)
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) or (frozenset([tuple(w)]) if w else frozenset())


def test_links_and_classes(awkward):
    docs = distinct_texts(awkward)
    sets = {d: shingles(d[1]) for d in docs}
    order = lambda d: (d[0] is None, d[0] or 0)
    first = {s: min((d for d in docs if sets[d] == s), key=order)[0] for s in set(sets.values())}
    links = {s: sum(1 for o in first if o != s and s and 5 * len(s & o) >= 4 * len(s | o)) for s in first}
    found = minhash_forest.near_duplicates(awkward).collect()
    assert len(found) == awkward.count()
    want = Counter((d["doc_id"], first[shingles(d["text"])], links[shingles(d["text"])]) for d in awkward.collect())
    assert Counter((r["doc_id"], r["class_id"], r["n_links"]) for r in found) == want
    assert links[shingles(next(t for i, t in docs if i == 0))] == 1


def test_stage_keeps_one_of_each_group(spark, awkward):
    kept = minhash_forest.stage(spark, awkward, "")
    assert kept.columns == awkward.columns
    sets = [shingles(r["text"]) for r in kept.collect()]
    assert all(5 * len(a & b) < 4 * len(a | b) for k, a in enumerate(sets) for b in sets[:k])
    assert {i for i, in kept.select("doc_id").collect()} >= {0, 1, 2, 4, 18}


def test_the_forest_reaches_its_recall():
    assert minhash_forest.chance(0.8, 7) >= minhash_forest.RECALL
    rng = np.random.default_rng(3)
    a = np.unique(rng.integers(0, 1 << 63, 500).astype(np.uint64))
    b = np.concatenate([a[:450], rng.integers(0, 1 << 63, 50).astype(np.uint64)])
    minhash = MinHash(2000)
    assert abs((minhash(a) == minhash(b)).mean() - 450 / 550) < 0.04
    linked, similarity = similar_pairs([a, b, a[:10]])
    assert linked.tolist() == [[False, True, False], [True, False, False], [False, False, False]]
    assert abs(similarity[0, 1] - 450 / 550) < 1e-6


def test_a_group_may_need_many_blocks(spark, monkeypatch):
    monkeypatch.setattr("salesloom.llm.verify.BLOCK", 4)
    base = [f"w{k}" for k in range(100)]
    rows = [(k, " ".join([*base[:99], f"z{k}"])) for k in range(30)]
    found = minhash_forest.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["n_links"] for r in found} == {29} and {r["group_id"] for r in found} == {0}


def test_components_of_a_chain_a_star_and_loops(spark):
    pairs = [(k, k + 1) for k in range(20)] + [(100, k) for k in range(101, 140)] + [(200, 200), (None, 1)]
    name = lambda k: None if k is None else k.to_bytes(2, "big")
    links = spark.createDataFrame([(name(a), name(b)) for a, b in pairs], "a binary, b binary")
    groups = defaultdict(set)
    for r in components(links).collect():
        groups[bytes(r["root"])].add(int.from_bytes(r["node"], "big"))
    assert dict(groups) == {name(0): set(range(21)), name(100): set(range(100, 140))}


def removed_by_hand(docs, length):
    seen = Counter()
    data = {d: (d[1] or "").encode() for d in docs}
    for b in data.values():
        seen.update(b[p : p + length] for p in range(len(b) - length + 1))
    out = {}
    for d, b in data.items():
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - length + 1):
            if seen[b[p : p + length]] > 1:
                gone[p : p + length] = True
        out[d] = gone
    return data, out


@pytest.mark.parametrize("partitions", ["1", "7"])
def test_repeated_strings(spark, awkward, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    small = awkward.filter("text IS NULL OR length(text) < 20000")
    docs = distinct_texts(small)
    data, gone = removed_by_hand(docs, suffix_dedup.LENGTH)
    try:
        found = suffix_dedup.substring_dedup(small).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    want = Counter()
    for r in small.collect():
        d = (r["doc_id"], r["text"])
        kept = np.frombuffer(data[d], dtype=np.uint8)[~gone[d]].tobytes()
        want[d[0], len(data[d]), int(gone[d].sum()), hashlib.sha256(kept).hexdigest()] += 1
    assert Counter((r["doc_id"], r["n_bytes"], r["n_removed"], hashlib.sha256(r["kept"]).hexdigest()) for r in found) == want
    assert sum(r["n_removed"] for r in found) > 1000
    assert all(r["n_removed"] == sum(s["end"] - s["start"] for s in r["spans"]) for r in found)


def test_shorter_repeats_are_told(spark):
    rng = random.Random(6)
    noise = lambda n: "".join(rng.choice("abcdefghij ") for _ in range(n))
    rows, shared = [], {}
    for k in range(60):
        passage = noise(rng.choice([300, 350, 390]))
        rows += [(2 * k + j, noise(500) + passage + noise(500)) for j in (0, 1)]
        shared[2 * k] = shared[2 * k + 1] = passage
    rows += [(500 + k, noise(1500)) for k in range(40)]
    found = {r["doc_id"]: r for r in suffix_dedup.substring_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert not any(r["n_removed"] for r in found.values()) and not any(found[k]["n_shared"] for k, _ in rows if k >= 500)
    # Both copies have the same anchors, and some of their leading bytes lie within the passage.
    assert all((found[2 * k]["n_shared"] > 0) == (found[2 * k + 1]["n_shared"] > 0) for k in range(60))
    assert sum(found[k]["n_shared"] > 0 for k in shared) >= 0.6 * len(shared)


def test_every_repeat_of_some_50_words_is_told(spark):
    rng = random.Random(8)
    noise = lambda n: "".join(rng.choice("abcdefghij ") for _ in range(n))
    size, rows = suffix_dedup.REACH + suffix_dedup.SHORT - 1, []
    for k in range(40):
        passage = noise(size)
        # In the middle, at the end, at the start and alone.
        texts = (noise(500) + passage + noise(500), noise(600) + passage, passage + noise(40), passage)
        rows += [(10 * k + j, t) for j, t in enumerate(texts)]
    rows += [(9100 + k, t) for k, t in enumerate([noise(suffix_dedup.SHORT)] * 2 + [noise(suffix_dedup.SHORT - 1)] * 2)]
    clean = [(9500 + k, noise(rng.choice([100, 160, 300, 360, 500, 900]))) for k in range(40)]
    found = {r["doc_id"]: r for r in suffix_dedup.substring_dedup(spark.createDataFrame(rows + clean, "doc_id long, text string")).collect()}
    assert all(found[k]["n_shared"] for k in range(400) if k % 10 < 4)
    assert found[9100]["n_shared"] == found[9101]["n_shared"] == 1 and not found[9102]["n_shared"]
    assert not any(found[k]["n_shared"] for k, _ in clean) and not any(r["n_removed"] for r in found.values())


def test_anchors_and_multikey_order():
    rng = np.random.default_rng(1)
    values = rng.integers(0, 9, 300).astype(np.uint32)
    assert all(a == k + values[k : k + 7].argmin() for k, a in enumerate(anchors(values, 7)))
    columns = [rng.integers(0, 4, 500) for _ in range(4)]
    rows = list(zip(*columns))
    assert [rows[k] for k in multikey_order(columns)] == sorted(rows)
    assert len(multikey_order([np.empty(0, int)] * 2)) == 0


def test_runs_that_cross_ranges():
    a, b, c = [1, 1, 1], [1, 2, 2], [5, 5, 5]
    ends = [(0, [0, 0, 0, 0, 0, 0, *a, *a]), (1, [*a, *a, *a, *a]), (2, [*a, *b, *c, *c])]
    out = across_boundaries(ends)
    assert [(r[4], r[6]) for r in out] == [(False, True), (True, True), (True, False)]
    assert out[1][1:3] == (a, a) and out[0][1] is None and out[2][2] is None


def test_lines(awkward):
    docs = sorted(distinct_texts(awkward), key=lambda d: (d[0] is not None, d[0] or 0, 0))
    found = line_dedup.line_dedup(awkward).collect()
    assert len(found) == awkward.count()
    by_id = {r["doc_id"]: r for r in found}
    same_nine = by_id[10]
    assert (same_nine["n_lines"], same_nine["n_removed"]) == (9, 8)  # all but what the first window alone covers, less what later ones cover
    assert by_id[8]["n_removed"] == 0 and by_id[9]["n_removed"] == 3
    assert by_id[9]["row"]["key"] == 1 and by_id[11]["text"] is None
    assert docs


def test_paragraphs(awkward):
    docs = sorted(distinct_texts(awkward), key=lambda d: (d[0] is None, d[0] or 0))
    found = {}
    for r in paragraph_dedup.paragraph_dedup(awkward).collect():
        found.setdefault(r["doc_id"], []).append((r["n_paragraphs"], r["removed"], r["text"]))
    assert found[9][0][:2] == (4, [0, 1, 2, 3])
    assert found[6][0][:2] == (1, [0]) and found[7][0][:2] == (1, [0]) and found[6][0][2] == ""
    assert found[11][0] == (1, [], None) and found[14][0][1] == []
    assert len(docs) < sum(map(len, found.values()))


def removed_short_lines(docs, n=25):
    """Short lines held whole by a string of ``n`` words, from or to the edge of a short line, that stood before."""
    seen, removed = set(), {}
    for d in sorted(docs, key=lambda d: (d[0] is None, d[0] or 0)):
        counts = [len(words(line)) for line in (d[1] or "").split("\n")]
        w, ends = words(d[1]), np.cumsum(counts).tolist()
        spans = [(k, e - c, e) for k, (c, e) in enumerate(zip(counts, ends)) if c]
        begins = {b for _, s, e in spans if e - s < n for b in (s, e - n) if 0 <= b <= len(w) - n}
        removed[d] = set()
        for b in sorted(begins):
            string = tuple(w[b : b + n])
            if string in seen:
                held = [k for k, s, e in spans if b <= s and e <= b + n]
                removed[d] |= set(range(held[0], held[-1] + 1))
            seen.add(string)
    return removed


def test_passages_of_short_lines(spark, awkward):
    rng = random.Random(11)
    new = lambda *sizes: [sentence(rng, n) for n in sizes]
    verse, near, table_rows, below = new(8, 16, 22, 15, 6), new(*[14] * 12), new(9, 9, 11, 24, 4), new(3, 40)
    changed = ["changed " + near[0].split(" ", 1)[1], *near[1:]]  # no string of 25 words that holds the first line is left
    texts = [
        verse,  # 0
        [*new(30, 5), *verse, *new(7, 60)],  # 1: copied between other lines
        near,  # 2
        changed,  # 3: a near copy of short lines only
        [*table_rows, *new(114)],  # 4
        [*new(50, 12, 3), "", *table_rows[:2], "--", *table_rows[2:], *new(80)],  # 5: blank lines in the copy
        [*new(60), *below],  # 6
        [*new(60), *below, *new(12)],  # 7: a heading goes with its paragraph
        [*new(60), *new(3), below[1]],  # 8: a heading of its own stays
        new(4, 5),  # 9
        None,
    ]
    texts[10:] = [texts[9], [*new(60), texts[9][0], *new(70)]]  # a whole short text; a set phrase by itself stays
    rows = [(k, "\n".join(t)) for k, t in enumerate(texts)]
    found = {r["doc_id"]: r["removed"] for r in paragraph_dedup.paragraph_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want = {1: [2, 3, 4, 5, 6], 3: list(range(12)), 5: [4, 5, 6, 7, 8, 9], 7: [1, 2], 8: [2], 10: [0, 1]}
    assert found == {k: want.get(k, []) for k in range(len(rows))}
    both = awkward.select("doc_id", "text").union(spark.createDataFrame([(k + 100, t) for k, t in rows], "doc_id long, text string"))
    by_hand = removed_short_lines(distinct_texts(both))
    keys = {(r["id"], r["key"]): (r["id"], r["text"]) for r in paragraph_dedup._own(both, "doc_id", "text").collect()}
    got = defaultdict(set)
    for r in paragraph_dedup.repeated_passages(both).collect():
        got[keys[r["id"], r["key"]]] |= set(range(r["at"], r["to"] + 1))
    assert got == {d: lines for d, lines in by_hand.items() if lines} and len(got) >= 5


def repeated_units(docs, n=25):
    """All pairs of paragraphs, components of links by their exact similarity: lines removed and paragraphs shared per document."""
    units = []
    for d in sorted(docs, key=lambda d: (d[0] is None, d[0] or 0)):
        lines = (d[1] or "").encode().split(b"\n")
        for at, to in paragraph_dedup._units(lines, [len(words(x.decode())) for x in lines], n):
            units.append((d, at, to, shingles(b"\n".join(lines[at : to + 1]).decode())))
    label = list(range(len(units)))
    for a, (*_, x) in enumerate(units):
        for b, (*_, y) in enumerate(units[:a]):
            if 5 * len(x & y) >= 4 * len(x | y):
                old, new = label[a], label[b]
                label = [new if k == old else k for k in label]
    removed, shared = defaultdict(set), Counter()
    for k, (d, at, to, _) in enumerate(units):
        if label.count(label[k]) > 1:
            shared[d] += 1
            if label.index(label[k]) < k:
                removed[d] |= set(range(at, to + 1))
    return removed, shared


def near_copies():
    rng = random.Random(5)
    lines = [sentence(rng, n) for n in (40, 60, 90, 30, 26, 120)]

    def edited(line, k):
        w = line.split(" ")
        w[k] = "edited"
        return " ".join(w)

    texts = []
    for k in range(40):
        own = [sentence(rng, rng.choice([5, 30, 70]))]
        picked = rng.sample(lines, 2)
        texts.append("\n".join([*own, *(edited(p, rng.randrange(len(p.split()))) if rng.random() < 0.7 else p for p in picked)]))
    return [(200 + k, t) for k, t in enumerate(texts)]


def test_paragraphs_equal_all_pairs(spark, awkward):
    docs = awkward.select("doc_id", "text").filter("text IS NULL OR length(text) < 20000").union(spark.createDataFrame(near_copies(), "doc_id long, text string"))
    removed, _ = repeated_units(distinct_texts(docs))
    keys = {(r["id"], r["key"]): (r["id"], r["text"]) for r in paragraph_dedup._own(docs, "doc_id", "text").collect()}
    got = defaultdict(set)
    for r in paragraph_dedup.repeated_paragraphs(docs).collect():
        got[keys[r["id"], r["key"]]] |= set(range(r["at"], r["to"] + 1))
    assert got == {d: lines for d, lines in removed.items() if lines} and len(got) > 30


def windows_by_hand(docs, n, reach):
    """Windows at anchors that stand at several places, by their words."""
    places = defaultdict(list)
    for d in sorted(docs, key=lambda d: (d[0] is None, d[0] or 0)):
        w = words(d[1])
        hashes = paragraph_dedup.word_hashes([(d[1] or "").encode()])[0]
        for at in paragraph_dedup.anchored(hashes, n, reach)[0].tolist():
            places[tuple(w[at : at + n])].append((d, at))
    return Counter((d, at, k == 0) for own in places.values() if len(own) > 1 for k, (d, at) in enumerate(own))


def embedded(seed, n=30):
    """Texts of long lines with passages of 51 words in the middle, across lines, and in two documents each."""
    rng = random.Random(seed)
    passages = [sentence(rng, 51).split(" ") for _ in range(n)]
    rows = []
    for k in range(2 * n):
        p = list(passages[k % n])
        if k % 4 == 1:
            p[20] += "\n"
        rows.append((1000 + k, " ".join([sentence(rng, rng.randint(30, 90)), " ".join(p), sentence(rng, rng.randint(30, 90))])))
    return rows, [" ".join(p) for p in passages], [(5000 + k, sentence(rng, 150)) for k in range(40)]


def test_passages_inside_long_lines(spark, awkward):
    rows, passages, clean = embedded(3)
    docs = spark.createDataFrame(rows + clean, "doc_id long, text string")
    found = {r["doc_id"]: r for r in paragraph_dedup.paragraph_dedup(docs).collect()}
    assert all(found[k]["n_shared"] > 0 for k, _ in rows) and not any(found[k]["n_shared"] for k, _ in clean)
    first = {k for k, _ in rows[: len(passages)]}
    texts = dict(rows + clean)
    for k, r in found.items():
        assert (r["text"] == texts[k]) == (k in first or k >= 5000)
        if not (k in first or k >= 5000):
            left = words(r["text"])
            own = words(passages[(k - 1000) % len(passages)])
            kept = [w for w in words(texts[k]) if w not in own]
            # Nothing but words of the passage goes, and at least a window of them.
            assert [w for w in left if w not in own] == kept and len(left) <= len(words(texts[k])) - 25
    both = awkward.select("doc_id", "text").union(docs)
    keys = {(r["id"], r["key"]): (r["id"], r["text"]) for r in paragraph_dedup._own(both, "doc_id", "text").collect()}
    got = Counter((keys[r["id"], r["key"]], r["word"], r["first"]) for r in paragraph_dedup.shared_passages(both).collect())
    assert got == windows_by_hand(distinct_texts(both), paragraph_dedup.MIN_WORDS, paragraph_dedup.REACH)


def test_every_string_has_a_window():
    rng = np.random.default_rng(2)
    hashes = rng.integers(0, 50, 400).astype(np.uint64)
    for n in range(51, 400, 37):
        at = paragraph_dedup.anchored(hashes[:n], 25, 26)[0]
        assert all(((at >= s) & (at + 25 <= s + 50)).any() for s in range(n - 49))
    copy = np.concatenate([rng.integers(0, 50, 77).astype(np.uint64), hashes[100:150], rng.integers(0, 50, 60).astype(np.uint64)])
    whole, part = ({(a, b) for a, b in zip(*paragraph_dedup.anchored(x, 25, 26)[1:])} for x in (hashes, copy))
    assert whole & part


def test_texts_are_hashed_together(monkeypatch):
    rng = np.random.default_rng(4)
    minhash = MinHash(24, seed=2)
    sets = [rng.integers(0, 1 << 63, n).astype(np.uint64) for n in (3, 0, 5000, 1, 4096, 4095, 2, 0)]
    assert (minhash.many(sets) == np.array([minhash(s) for s in sets])).all() and minhash.many([]).shape == (0, 24)
    sizes = [0, 3, 25, 49, 50, 51, 300, 0, 24, 77]
    hashes = rng.integers(0, 9, sum(sizes)).astype(np.uint64)
    begin = np.concatenate([[0], np.cumsum(sizes)])
    parts = [paragraph_dedup.anchored(hashes[a:b], 25, 26) for a, b in zip(begin, begin[1:])]
    whole = paragraph_dedup.anchored_texts(hashes, begin, 25, 26)
    assert whole[0].tolist() == [a + k for a, p in zip(begin.tolist(), parts) for k in p[0].tolist()]
    assert all((whole[k] == np.concatenate([p[k] for p in parts])).all() for k in (1, 2))
    # One call hashes the words of a batch, whatever is made of them.
    calls = []
    for module in ("shingles", "paragraph_dedup"):
        own = getattr(import_module(f"salesloom.llm.{module}"), "word_hashes")
        monkeypatch.setattr(f"salesloom.llm.{module}.word_hashes", lambda texts, f=own: calls.append(len(texts)) or f(texts))
    texts = [" ".join(f"w{k}{j % 40}" for j in range(60)) for k in range(50)]
    batch = pa.RecordBatch.from_pydict({"id": list(range(50)), "key": list(range(50)), "text": texts})
    assert sum(b.num_rows for b in paragraph_dedup._banded(iter([batch]), 12, 3, 25)) == 50 and len(calls) == 1
    assert next(paragraph_dedup._anchored(iter([batch]), 25, 26)).num_rows == 50 and len(calls) == 2


def test_words_are_cut_from_lines():
    text = "a b c\nd é f g\n\nh i"
    assert paragraph_dedup.without(text, [], [1], 3) == "a\né f g\n\nh i"
    assert paragraph_dedup.without(text, [3], [3], 4) == "a b c\n"
    assert paragraph_dedup.without(text, [0], [], 4) == "d é f g\n\nh i"
    assert paragraph_dedup.without("x. y! z", [], [0], 1) == "y! z"


@pytest.mark.parametrize("partitions", ["1", "5", "16"])
def test_buckets_that_cross_ranges(spark, partitions):
    rng = random.Random(9)
    rows = sorted({(rng.choice([1, 1, 1, 2, 3, 40]), bytes([rng.randrange(256), rng.randrange(256)])) for _ in range(900)})
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        df = spark.createDataFrame([(k, bytearray(c)) for k, c in rows], "bucket long, cls binary").repartition(3)
        links = verify.bucket_links(df, "test-buckets").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    graph = defaultdict(set)
    for r in links:
        graph[bytes(r["a"])].add(bytes(r["b"])), graph[bytes(r["b"])].add(bytes(r["a"]))
    members = defaultdict(list)
    for k, c in rows:
        members[k].append(c)
    for own in members.values():
        reached, todo = {own[0]}, [own[0]]
        while todo:
            new = graph[todo.pop()] - reached
            reached |= new
            todo += new
        assert set(own) <= reached
    assert len(links) < len(rows) + 40 and verify.bucket_links(df.limit(0), "no-buckets").count() == 0


def test_a_common_line_does_not_have_all_its_blocks_compared(spark, monkeypatch):
    """Blocks around one common line meet in buckets by chains; they are not dealt out as one group of all pairs."""
    monkeypatch.setattr(verify, "BLOCK", 8)
    rng = random.Random(21)
    common = sentence(rng, 18)
    rows = [(k, common + "\n" + sentence(rng, 12)) for k in range(120)]
    rows += [(200 + k, text.rsplit(" ", 1)[0] + " changed") for k, text in rows[:40:4]]
    dealt, own = [], paragraph_dedup.verified_links

    def counted(members, chance):
        dealt.append(members.select("cls", "blocks").distinct().agg(F.count("*"), F.sum("blocks")).first())
        return own(members, chance)

    monkeypatch.setattr(paragraph_dedup, "verified_links", counted)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    later = {r["id"] for r in paragraph_dedup.repeated_paragraphs(docs).collect()}
    removed, _ = repeated_units(distinct_texts(docs))
    assert later == {d[0] for d, lines in removed.items() if lines} == {k for k, _ in rows if k >= 200}
    (members, calls), = dealt
    assert 20 <= members <= 60 and calls <= 2 * members  # 130 members in 17 blocks each, where all were compared


def test_narrowed_groups_keep_every_link(spark, monkeypatch):
    monkeypatch.setattr(verify, "BLOCK", 4)
    rng = np.random.default_rng(8)
    pool = rng.integers(0, 1 << 63, 400).astype(np.uint64)
    sets = []
    for n in (1, 2, 5, 9, 10, 40, 75):
        for _ in range(9):
            base = rng.choice(pool, n, replace=False)
            for share in (0, 0.05, 0.1, 0.1, 0.15, 0.3):
                other = rng.choice(pool, n)
                sets.append(np.unique(np.where(rng.random(n) < share, other, base)))
    rows = {bytes(set_id(s)): (bytearray(set_id(s)), bytearray(bytes([k // 6 % 3]) * 16), len(s), bytearray(s.astype("<u8").tobytes())) for k, s in enumerate(sets)}
    rows = [*rows.values(), *list(rows.values())[:20]]  # a document that came in several rows
    groups = spark.createDataFrame(rows, "cls binary, root binary, n long, shingles binary")
    members = verify.blocked(groups)
    chance = partial(paragraph_dedup._chance, bands=12, rows=3)
    found = []
    for part in (members, verify.narrowed(members)):
        links = verify.verified_links(part, chance)
        found.append({(bytes(r["node"]), bytes(r["root"])) for r in verify.link_groups(links)[1].collect()})
    assert found[0] == found[1] and len(found[0]) > 60
    assert verify.narrowed(members).count() < members.count() and verify.narrowed(members.limit(0)).count() == 0


def test_few_links_are_followed_in_one_task(spark):
    rng = random.Random(13)
    nodes = [rng.randbytes(16) for _ in range(400)]
    pairs = [(nodes[k], nodes[k + 1]) for k in range(0, 150)] + [(rng.choice(nodes[150:]), rng.choice(nodes[150:])) for _ in range(170)]
    links = spark.createDataFrame([(bytearray(a), bytearray(b)) for a, b in [*pairs, *pairs[:9]]], "a binary, b binary").repartition(5)
    found = [sorted((bytes(r["node"]), bytes(r["root"])) for r in components(links, "test-links", few).collect()) for few in (0, 10, 1000)]
    assert found[0] == found[1] == found[2] and len({root for _, root in found[0]}) > 20
    assert components(links.limit(0), "no-links", 1000).count() == 0


def test_buckets_that_cross_batches(spark, monkeypatch):
    monkeypatch.setattr(verify, "STAR_ROWS", 7)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    test_buckets_that_cross_ranges(spark, "5")
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before


def test_one_scan_gives_what_three_give(monkeypatch):
    rng = random.Random(5)
    texts = ["\n".join(sentence(rng, rng.choice([0, 3, 9, 14, 40, 90])) for _ in range(rng.randint(1, 9))) for _ in range(40)] + [None, "", "a b"]
    batch = pa.RecordBatch.from_pydict({"id": list(range(len(texts))), "key": [7 * k for k in range(len(texts))], "text": texts})
    calls, own = [], paragraph_dedup.word_hashes
    monkeypatch.setattr(paragraph_dedup, "word_hashes", lambda x: calls.append(1) or own(x))
    parts = list(paragraph_dedup._all(iter([batch]), 12, 3, 25, 26))
    assert len(calls) == 1 and [p.column("kind").unique().to_pylist() for p in parts] == [[0], [1], [2]]
    alone = paragraph_dedup._banded(iter([batch]), 12, 3, 25), paragraph_dedup._windows(iter([batch]), 25), paragraph_dedup._anchored(iter([batch]), 25, 26)
    for part, one in zip(parts, alone):
        one = next(one)
        assert part.select(one.schema.names).to_pydict() == one.to_pydict() and one.num_rows > 20


def test_blocks_of_short_lines_end_where_copies_end_too():
    lines = [f"{k} b c d e f g h".encode() for k in range(40)]
    blocks = paragraph_dedup._units(lines, [8] * 40, 25)
    assert [k for a, b in blocks for k in range(a, b + 1)] == list(range(40))
    assert all(25 <= 8 * (b - a + 1) <= 100 + 8 + 24 for a, b in blocks)
    shifted = paragraph_dedup._units([b"x y z"] + lines, [3] + [8] * 40, 25)
    assert len({(a + 1, b + 1) for a, b in blocks} & set(shifted)) >= len(blocks) - 3
    assert paragraph_dedup._units(lines[:3], [30, 4, 30], 25) == [(0, 0), (2, 2)]
    assert paragraph_dedup._units(lines[:2], [0, 4], 25) == [(1, 1)] and paragraph_dedup._units([b""], [0], 25) == []


def test_bands_are_tuned():
    bands, rows = paragraph_dedup.tuned_bands(0.8, 0.9998, 64)
    assert bands * rows <= 64 and 1 - (1 - 0.8**rows) ** bands >= 0.9998
    with pytest.raises(ValueError):
        paragraph_dedup.tuned_bands(0.5, 0.999999, 4)


def test_empty_tables(nothing):
    for operator in (minhash_forest.near_duplicates, suffix_dedup.substring_dedup, line_dedup.line_dedup, paragraph_dedup.paragraph_dedup):
        assert operator(nothing).count() == 0


def test_shingle_sets_of_few_and_no_words():
    sets = shingle_sets([b"", b"  ", b"a b", b"A  B", b"a b c d e", "é".encode() * 3])
    assert [len(s) for s in sets] == [0, 0, 1, 1, 1, 1]
    assert sets[2] == sets[3]
