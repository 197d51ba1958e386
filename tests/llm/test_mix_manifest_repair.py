"""Mixing, the Merkle manifest and conversation repair against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction
from itertools import product

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from salesloom.llm import conversation_repair, merkle, mixing

WHITE = " \t\n\x0b\f\r"


def n_words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


# Mixing


def test_targets_stop_at_three_times_the_source():
    # Weights 1, 2, 3, 1 and 2 in the order of the names, null last.
    got = mixing.targets({None: 0, "d": 799, "a": 100, "b": 100, "c": 1})
    assert got == {"a": 300, "b": 300, "c": 3, "d": 397, None: 0}
    assert mixing.targets({"b": 400, "a": 500}) == {"a": 300, "b": 600}
    assert mixing.targets({"b": 50, "a": 100, None: 551}) == {"a": Fraction(551, 4), "b": 150, None: Fraction(3 * 551, 4)}


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.one_of(st.none(), st.text(max_size=3)), st.integers(0, 500), max_size=9))
def test_targets_share_all_words_by_weight(sizes):
    got = mixing.targets(sizes)
    assert sum(got.values()) == sum(sizes.values())
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: k % 3 + 1 for k, s in enumerate(names)}
    free = {got[s] / weight[s] for s in names if got[s] < 3 * sizes[s]}
    assert len(free) <= 1
    assert all(got[s] <= 3 * sizes[s] for s in names)
    assert all(got[s] / weight[s] <= level for level in free for s in names)


@pytest.mark.parametrize("n", [1, 2, 3, 17, 64, 1000])
def test_permutations(n):
    first, second = (mixing.permuted(np.arange(n), n, 5, k).tolist() for k in (1, 2))
    assert sorted(first) == sorted(second) == list(range(n))
    assert n < 17 or first != second


def test_shard_counts_are_drawn_around_their_expectation():
    shares = np.array([0.503, 0.25, 0.1234, 0.1236])
    draws = np.array([mixing.shard_counts(k, 100, shares, 3) for k in range(400)])
    assert (draws.sum(axis=1) == 100).all() and len(np.unique(draws, axis=0)) > 2
    assert np.abs(draws.mean(axis=0) - 100 * shares).max() < 0.15
    assert (mixing.shard_counts(7, 100, shares, 3) == draws[7]).all()


def test_mix(spark, awkward):
    docs = awkward.withColumn("source", F.when(F.col("doc_id") % 3 == 0, F.col("source")).otherwise(F.concat(F.lit("s"), F.col("doc_id") % 4)))
    made = mixing.mixture(docs, block=16, shard=400)
    found = [r.asDict() for r in made.taken().collect()]
    rows = docs.collect()
    assert Counter((r["id"], r["source"], r["size"]) for r in found) == Counter((r["doc_id"], r["source"], n_words(r["text"])) for r in rows)
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in found:
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
    want = mixing.targets(dict(sizes))
    for r in found:
        assert r["taken"] <= 3 * r["size"] and r["source_size"] == sizes[r["source"]] and r["target"] == float(want[r["source"]])
    for s, target in want.items():
        assert abs(taken[s] - target) <= 16 * 6
    again = mixing.mixture(docs.repartition(3), block=16, shard=400).taken().collect()
    assert Counter((r["id"], r["key"], r["taken"]) for r in again) == Counter((r["id"], r["key"], r["taken"]) for r in found)
    # The slots' own texts hold as many words, no place twice, and only words of their source.
    texts = made.texts(docs).collect()
    assert len({(r["shard"], r["position"]) for r in texts}) == len(texts) == made.slots.count()
    got = Counter()
    for r in texts:
        got[r["source_no"]] += n_words(r["text"])
        assert n_words(r["text"]) <= 16 and r["pass"] < 3
    names = {r["source_no"]: r["source"] for r in found}
    assert {names[k]: n for k, n in got.items()} == {s: n for s, n in taken.items() if n}
    passages = {names[r["source_no"]]: "" for r in found}
    for r in sorted(rows, key=lambda r: str(r["doc_id"])):
        passages[r["source"]] += " " + (r["text"] or "")
    vocabulary = {s: set(re.findall(r"[^\x20\x09-\x0D]+", t)) for s, t in passages.items()}
    assert all(set(r["text"].split(" ")) <= vocabulary[names[r["source_no"]]] for r in texts)


def test_mix_of_nothing(nothing, spark):
    assert mixing.mixture(nothing).taken().count() == 0
    empty = spark.createDataFrame([(1, None, "a"), (2, "", "a"), (2, " ", None)], "doc_id long, text string, source string")
    assert [(r["size"], r["target"], r["taken"]) for r in mixing.mixture(empty).taken().collect()] == [(0, 0.0, 0)] * 3


# Merkle manifest


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def tree(digests):
    levels = [digests]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][k : k + 3]) for k in range(0, len(levels[-1]), 3)])
    return levels


def run_mates(levels, index):
    out = []
    for level in levels[:-1]:
        first = index - index % 3
        out.append((level[first:index], level[index + 1 : first + 3]))
        index //= 3
    return out


def manifest_rows(rows):
    def leaf(r, text):
        return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (r["doc_id"], r["source"], r["lang"], r["n_chars"], text)])

    groups = defaultdict(list)
    for r in rows:
        groups[r["source"]].append(r)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    for s in names:
        groups[s].sort(key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0, leaf(r, r["text"])))
    trees = [tree([leaf(r, r["text"]) for r in groups[s]]) for s in names]
    top = tree([t[-1][0] for t in trees])
    for k, s in enumerate(names):
        for at, r in enumerate(groups[s]):
            steps = run_mates(trees[k], at) + run_mates(top, k)
            text = r["text"]
            if text is not None and r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 2 == 0:
                text = text.replace("\n", "")
            folded = leaf(r, text)
            for before, after in steps:
                folded = h(*before, folded, *after)
            proof = [d for before, after in steps for d in before + after]
            yield r["doc_id"], leaf(r, r["text"]), trees[k][-1][0], top[-1][0], h(*proof), folded


def proved(docs, levels):
    order = [F.col("doc_id").isNull(), F.col("doc_id"), F.col("digest")]
    made = merkle.manifest(merkle.document_leaves(docs), order, levels=levels)
    rows = made.proofs("tampered", "doc_id").collect()
    return made, Counter((r["doc_id"], r["leaf"], r["subroot"], r["root"], h(*r["proof"]), r["folded"]) for r in rows)


@pytest.mark.parametrize("levels", [1, 2, 7])
def test_manifest(awkward, levels):
    rows = awkward.collect()
    made, found = proved(awkward, levels)
    assert found == Counter(manifest_rows(rows))
    # The log in its order is what one builder would have written.
    log = defaultdict(list)
    for r in sorted(made.entries().filter("NOT top").collect(), key=lambda r: r["position"]):
        log[r["grp"]].append((r["level"], r["digest"], r["position"]))
    for group, entries in log.items():
        assert [p for *_, p in entries] == list(range(len(entries)))
        leaves = [d for level, d, _ in entries if level == 0]
        # Leaves are complete at once: each comes before the nodes that it completes.
        own, all_nodes = merkle.subtree_nodes(len(leaves), leaves, 0, 0, 30), []
        merged = {}
        for level, index, digest in own:
            merged.setdefault(min((index + 1) * 3**level, len(leaves)) - 1, []).append((level, digest))
        for k, leaf in enumerate(leaves):
            all_nodes += [(0, leaf), *merged.get(k, [])]
        assert [(level, d) for level, d, _ in entries] == all_nodes, group


def test_manifest_of_many_sources_and_of_nothing(spark, nothing):
    made, found = proved(nothing, 7)
    assert not found
    docs = spark.range(60).selectExpr(
        "id doc_id", "concat('a\\nb', id) text", "'en' lang", "if(id = 7, null, concat('ü', id % 31)) source", "id n_chars"
    )
    for levels in (1, 2):
        assert proved(docs, levels)[1] == Counter(manifest_rows(docs.collect()))


@pytest.mark.parametrize("n", [1, 2, 3, 4, 9, 10, 28, 100])
def test_positions_are_completion_order(n):
    order = []
    for leaf in range(n):
        order.append((0, leaf))
        for level in range(1, merkle.height(n) + 1):
            if (leaf + 1) % 3**level == 0 or leaf == n - 1:
                order.append((level, leaf // 3**level))
            else:
                break
    assert [merkle.position(n, *node) for node in order] == list(range(len(order)))


# Conversation repair


def brute_repairs(rows):
    """Every edit of every row tried, states kept by cost and letters."""
    conversations, out = defaultdict(list), []
    for conv, turn, role, text in rows:
        conversations[conv]
        role, text = (" " if v is None else v for v in (role, text))
        hit = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if hit == 0:
            continue
        text = "" if hit == 1 else re.sub("[.!?]", "", text) if hit == 2 else text
        conversations[conv] += [(turn, "user" if hit == 4 else role, text)] * (2 if hit == 3 else 1)
    for conv, own in conversations.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.md5(r[2].encode()).hexdigest()))
        turns = [t for t, *_ in own if t is not None]
        faults, seen = [], set()
        for _, role, text in own:
            said = text.rstrip(WHITE)
            faults.append("blank" if not said else "duplicate" if (role, text) in seen else "truncated" if said[-1] not in ".!?" else "")
            seen.add((role, text))
        cost, audit, kept = cheapest_repair([(r, t, f) for (_, r, t), f in zip(own, faults)])
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
        out.append((conv, gaps, *counts, illegal, cost, audit, h("\n".join(f"{r}:{t}" for r, t in kept))))
    return Counter(out)


def cheapest_repair(rows):
    """All audits by exhaustive search over the pattern's states, the best per state and row."""
    follows = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}
    full = {"u": "user", "a": "assistant"}
    best = {"": (0, "", ())}

    def inserts(best):
        out = dict(best)
        for _ in range(3):
            for state, (cost, audit, kept) in list(out.items()):
                for to in "ua":
                    if (state, to) in follows:
                        new = (cost + 3, audit + "I", (*kept, (full[to], "")))
                        out[to] = min(out.get(to, new), new)
        return out

    for role, text, fault in rows:
        found = {}
        for state, (cost, audit, kept) in inserts(best).items():
            options = [(state, (cost + 4, audit + "D", kept))]
            if fault not in ("blank", "duplicate"):
                more = 3 if fault == "truncated" else 0
                if (state, role[:1]) in follows:
                    options.append((role[:1], (cost + more, audit + "K", (*kept, (role, text)))))
                options += [(to, (cost + more + 3, audit + "R", (*kept, (full[to], text)))) for to in "ua" if (state, to) in follows]
            for to, new in options:
                found[to] = min(found.get(to, new), new)
        best = found
    return min(v for state, v in inserts(best).items() if state in ("", "a"))


def conversation_rows():
    rng = random.Random(13)
    texts = ["Yes.", "No", "", " \t", "What? ", "yes.\n", "Done!", None, "ünï.", "So: 1. "]
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", None, "users", "Assistant"]
    rows = []
    for conv in [*range(120), None]:
        for turn in range(rng.randint(0, 14)):
            rows.append((conv, rng.choice([turn, turn, turn + 1, None]), rng.choice(roles), rng.choice(texts)))
    rows += [(500, k, ["user", "assistant"][k % 2], f"Turn {k}.") for k in range(700)]
    return [*rows, *rows[:9], *[(501, 3, "user", "Same.")] * 12]


@pytest.mark.parametrize(("span", "rules"), [(4096, 192), (3, 5)])
def test_repairs(spark, span, rules):
    rows = conversation_rows()
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    made = conversation_repair.repair(conversation_repair.marked(conversation_repair.damaged(df)), rules=rules, span=span)
    found = made.reports.join(made.digests(), "grp").collect()
    want = {w[0]: w[1:] for w in brute_repairs(rows)}
    got = {(None if r["grp"] == "0" else int(r["grp"][1:])): r for r in found}
    for conv, r in got.items():
        assert (r["gaps"], r["blank"], r["duplicate"], r["truncated"], r["illegal"], r["cost"], r["audit"], r["repaired_sha256"]) == want[conv], conv
    assert all(w == (0, 0, 0, 0, 0, 0, "", h("")) for conv, w in want.items() if conv not in got)
    repaired = defaultdict(list)
    for r in made.repaired().collect():
        repaired[r["grp"]].append((r["nth"], r["role"], r["text"], r["edit"]))
    for r in found:
        own = sorted(repaired[r["grp"]])
        assert h("\n".join(f"{role}:{text}" for _, role, text, _ in own)) == r["repaired_sha256"]
        assert "".join(e for *_, e in own) == r["audit"].replace("D", "")


def test_repair_query(spark, tmp_path):
    rows = conversation_rows()
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, grp string, copies int")
    df.write.parquet(f"{tmp_path}/conversations.parquet")
    df.limit(0).write.parquet(f"{tmp_path}/none/conversations.parquet")
    found = conversation_repair.op13_conversation_repair(spark, str(tmp_path))
    assert Counter(tuple(r) for r in found.collect()) == brute_repairs(rows)
    assert conversation_repair.op13_conversation_repair(spark, f"{tmp_path}/none").count() == 0


def test_matrices_equal_the_search():
    singles = list("Dsuao") + list("SUAO")
    matrices = conversation_repair.rule_matrices([])
    for symbols in product(singles, repeat=3):
        rows = [({"D": "u", "o": "x"}.get(s.lower() if s != "D" else s, s.lower()), str(k), "blank" if s == "D" else "truncated" if s.isupper() else "") for k, s in enumerate(symbols)]
        matrix = conversation_repair.sequence_matrix("".join(symbols), [], matrices)
        assert conversation_repair.cheapest(matrix) == cheapest_repair(rows)[:2]


def test_grammar_rules(spark):
    shapes = ["ua" * 40, "sua" + "ua" * 9, "uuuu", "D" * 9, "ua"]
    df = spark.createDataFrame([(s,) for s in shapes], "symbols string")
    rules = conversation_repair.grammar(df, rules=20, span=16)
    assert rules[0] == "ua" and len(rules) <= 20
    matrices = conversation_repair.rule_matrices(rules)
    for s in shapes:
        assert len(conversation_repair.compressed(s, rules)) <= len(s)
        whole = conversation_repair.sequence_matrix(s, rules, matrices)
        assert conversation_repair.flat(whole) == conversation_repair.flat(conversation_repair.sequence_matrix(s, [], matrices))
    assert len(conversation_repair.compressed(shapes[0], rules)) <= 10
