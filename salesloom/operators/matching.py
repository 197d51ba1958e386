"""Best match by shared words, without the pairs that a common word makes."""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesloom.operators.joins import shuffled_join

STEP = Decimal(10**20)  # more than twice any whole number of 64 bits
HALF = STEP / 2


def _overlap(a: str, b: str) -> Column:
    return F.size(F.array_intersect(a, b))


def _rank() -> Column:
    """Score and entry as one number, greater for more shared words, then for a lower id.

    The greatest number of a set is found in a hash table with a row a set; for the greatest struct
    Spark would sort all pairs.
    """
    score = _overlap("known", "words").cast("decimal(10,0)") * F.lit(STEP)
    return (score - F.col("entry").cast("decimal(20,0)")).cast("decimal(38,0)").alias("rank")


def _best(ranks: DataFrame) -> DataFrame:
    """set_id and ``best`` (score and negative id) from set_id and rank."""
    top = ranks.groupBy("set_id").agg(F.max("rank").alias("top")).withColumn("top", (F.col("top") + F.lit(HALF)).cast("decimal(38,0)"))
    rest = (F.col("top") % F.lit(STEP)).cast("decimal(21,0)")
    score = ((F.col("top") - rest) / F.lit(STEP)).cast("int")
    return top.select("set_id", F.struct(score.alias("score"), (rest - F.lit(HALF)).cast("bigint").alias("earlier")).alias("best"))


@dataclass
class OverlapSearch:
    """The steps of ``overlap_search``, each of which can be looked at on its own.

    ``bounds``: set_id, known (the words that some entry has, the rarest first) and ``best`` (score and
    negative id of the best probe); ``candidates``: set_id, entry, known.
    """

    entries: DataFrame
    bounds: DataFrame
    candidates: DataFrame

    def best(self) -> DataFrame:
        """set_id, entry and score of the entry with the most shared words; ties go to the least id."""
        met = _best(shuffled_join(self.candidates, self.entries, "entry").select("set_id", _rank()))
        # Two rows a set at most.
        found = met.unionByName(self.bounds.select("set_id", "best"))
        found = found.groupBy("set_id").agg(F.max("best").alias("best"))
        return found.select("set_id", (-F.col("best.earlier")).alias("entry"), F.col("best.score").cast("int").alias("score"))


def overlap_search(sets: DataFrame, entries: DataFrame) -> OverlapSearch:
    """For every set of words the entry that shares the most of them: exact, by prefix filtering.

    ``sets``: set_id, words; ``entries``: entry (a whole number, unique), words; the words of a row differ.
    A set's words are put in the order of how many entries have them, the rarest first. For each word the
    first entry that has it is tried, which gives a score s that some entry reaches, and the best entry
    where s is 1. An entry that shares s of n words has one of the n - s + 1 rarest, so only those make
    candidates, and exact intersections decide. A word that all entries have is last in every
    set and makes pairs only where a set has no other that two entries could share. Sets without a known word have no row.
    """
    placed = entries.select("entry", F.explode("words").alias("word"))
    vocabulary = placed.groupBy("word").agg(F.count(F.lit(1)).alias("entries"), F.min("entry").alias("first"))
    asked = sets.select("set_id", F.explode("words").alias("word"))
    known = shuffled_join(asked, vocabulary, "word").groupBy("set_id").agg(
        F.sort_array(F.collect_list(F.struct("entries", "word", "first"))).alias("ranked")
    )
    known = known.select("set_id", F.col("ranked.word").alias("known"), F.array_distinct("ranked.first").alias("firsts"))
    # A probe a word: as many rows as the sets have words.
    probes = known.select("set_id", "known", F.explode("firsts").alias("entry"))
    probes = shuffled_join(probes, entries, "entry")
    # The words of a set are met again by its id: no aggregate holds or sorts them once per pair.
    bounds = known.select("set_id", "known").join(_best(probes.select("set_id", _rank())), "set_id")
    # A single shared word is settled by the probes: the least id of each word was tried.
    least = F.greatest(F.col("best.score"), F.lit(2))
    prefix = F.slice("known", F.lit(1), F.greatest(F.size("known") - least + 1, F.lit(0)))
    wanted = bounds.select("set_id", F.explode(prefix).alias("word"))
    candidates = shuffled_join(wanted, placed, "word").select("set_id", "entry").distinct()
    candidates = shuffled_join(candidates, known.select("set_id", "known"), "set_id")
    return OverlapSearch(entries, bounds, candidates)
