"""Best match by shared words against all pairs."""

import random

import pytest

from salesloom import schemas
from salesloom.operators.matching import overlap_search
from salesloom.plans import support


def brute(sets, entries):
    out = {}
    for key, words in sets.items():
        scores = [(len(words & own), -entry) for entry, own in entries.items()]
        score, earlier = max(scores, default=(0, 0))
        if score:
            out[key] = (-earlier, score)
    return out


def frames(spark, sets, entries):
    left = spark.createDataFrame([(k, sorted(w)) for k, w in sets.items()], "set_id string, words array<string>")
    right = spark.createDataFrame([(k, sorted(w)) for k, w in entries.items()], "entry long, words array<string>")
    return left, right


@pytest.mark.parametrize("seed", range(4))
def test_best_overlap(spark, seed):
    rng = random.Random(seed)
    # Words of very different frequency, so that ties and common words are many.
    words = [f"w{k}" for k in range(30)]
    draw = lambda n: {rng.choice(words[: rng.choice([3, 10, 30])]) for _ in range(n)}
    entries = {k: draw(rng.randint(0, 9)) for k in range(60)}
    sets = {f"q{k}": draw(rng.randint(0, 8)) | ({"unknown"} if k % 3 == 0 else set()) for k in range(150)}
    found = overlap_search(*frames(spark, sets, entries)).best().collect()
    assert {r["set_id"]: (r["entry"], r["score"]) for r in found} == brute(sets, entries)


def test_a_word_of_all_entries_makes_no_pairs(spark):
    entries = {k: {"common", f"own{k}", f"pair{k // 2}"} for k in range(300)}
    sets = {f"q{k}": {"common", f"own{k}"} for k in range(200)} | {"last": {"common"}, "pair": {"common", "pair7"}}
    search = overlap_search(*frames(spark, sets, entries))
    assert search.candidates.count() <= 2 * len(sets)
    found = {r["set_id"]: (r["entry"], r["score"]) for r in search.best().collect()}
    assert found == brute(sets, entries)
    assert found["last"] == (0, 1) and found["pair"] == (14, 2)


def test_two_common_words(spark):
    # Both words are in every entry: the first entry has them, so one word makes the candidates.
    entries = {k: {"a", "b"} for k in range(50)}
    search = overlap_search(*frames(spark, {"q": {"a", "b"}}, entries))
    assert search.candidates.count() == 50
    assert search.best().collect()[0]["entry"] == 0


def test_equal_questions_are_looked_up_once(spark):
    faq = spark.createDataFrame([(2, "pay", "how pay order", "by card", "money"), (1, "ship", "ship order", "soon", "way")], schemas.FAQ)
    asked = spark.createDataFrame([(f"q{k}", "Pay order now") for k in range(40)] + [("x", None)], "question_id string, question string")
    rows = {r["question_id"]: r for r in support.match_faq(asked, faq, pattern="[a-z]+").collect()}
    assert {(r["item_id"], r["score"]) for k, r in rows.items() if k != "x"} == {(2, 2)}
    assert rows["x"]["found"] is False and len(rows) == 41


def test_no_rows(spark):
    left, right = frames(spark, {"q": {"a"}}, {1: {"a"}})
    assert overlap_search(left.limit(0), right).best().count() == 0
    assert overlap_search(left, right.limit(0)).best().count() == 0


def test_ids_over_the_whole_range(spark):
    least, most = -(2**63) + 1, 2**63 - 1
    entries = {least: {"a", "b"}, -5: {"a", "b"}, 0: {"a"}, 7: {"a", "b", "c"}, most: {"c", "d", "e"}}
    sets = {"low": {"a", "b"}, "three": {"a", "b", "c"}, "high": {"c", "d"}, "one": {"a", "x"}}
    found = overlap_search(*frames(spark, sets, entries)).best().collect()
    assert {r["set_id"]: (r["entry"], r["score"]) for r in found} == brute(sets, entries)


def test_no_aggregate_of_pairs_holds_words(spark):
    # Spark sorts rows for an aggregate of a struct or an array; here that was each set's words once per pair.
    entries = {k: {"common", f"own{k}"} for k in range(20)}
    search = overlap_search(*frames(spark, {f"q{k}": {"common", f"own{k}"} for k in range(20)}, entries))
    for df in (search.bounds, search.candidates):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert "first(known" not in plan and "max(struct(" not in plan and "max(if" not in plan
