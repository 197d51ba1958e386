"""Quality rules whose cutoffs are chosen with exact binomial bounds on labelled documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from salesloom.llm.common import spread_out, table, written

BREAK = r"[\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
STRATA = ("en", "de", "fr", "es")  # any other language, or none, is the stratum "other"
RISK = 0.02  # share of good documents of a stratum that all rules together may reject
CONFIDENCE = 0.95  # that this holds for every stratum
MARGINS = 9  # steps of the cutoffs from near 1000 down to the highest share that was seen
LEVELS = 40  # further steps, down to cutoffs that each reject ``RISK`` of the ranked documents
RANKED = "0123"  # first hexadecimal digits of the MD5 of an id whose labels order the cutoffs; the others test them
RULES = ("symbols", "bangs", "repeats", "dup_lines", "sameness")


def _count_of(text: str, chars: str) -> Column:
    """How often single-byte characters occur; replacing is far cheaper than a regular expression."""
    return sum((F.octet_length(text) - F.octet_length(F.replace(F.col(text), F.lit(c), F.lit(""))) for c in chars), F.lit(0))


def measured(docs: DataFrame) -> DataFrame:
    """The base counts of every document (``text`` not null): one pass, no shuffle, arrays within a row."""
    split = docs.withColumn("words", F.array_remove(F.split("text", BREAK), ""))
    solid = F.filter(F.split("text", "\n"), lambda line: F.length(F.translate(line, SPACES, "")) > 0)
    counted = split.select(
        *docs.drop("text").columns,
        "words",
        F.size("words").cast("long").alias("n_words"),
        (F.length("text") - _count_of("text", SPACES)).cast("long").alias("word_chars"),
        _count_of("text", SYMBOLS).cast("long").alias("n_symbols"),
        _count_of("text", "!").cast("long").alias("n_bangs"),
        solid.alias("lines"),
    )
    starts = F.sequence(F.lit(0), F.size("words") - 3)
    three = F.transform(starts, lambda i: F.xxhash64(*[F.get("words", i + k) for k in range(3)]))
    counted = counted.select(
        *[c for c in counted.columns if c not in ("words", "lines")],
        F.when(F.size("words") >= 3, three).alias("windows"),
        F.size(F.array_distinct("words")).cast("long").alias("n_different"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
    )
    # Most texts repeat no window: only the others are sorted.
    some = F.size(F.array_distinct("windows")) < F.size("windows")
    placed = F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    counted = counted.withColumn("sorted", F.when(some, placed)).drop("windows")
    twice = F.filter(
        "sorted",
        lambda w, i: F.coalesce((w["h"] == F.get("sorted", i - 1)["h"]) | (w["h"] == F.get("sorted", i + 1)["h"]), (w["h"] == F.get("sorted", i - 1)["h"]), (w["h"] == F.get("sorted", i + 1)["h"])),
    )
    covered = F.array_distinct(F.flatten(F.transform(twice, lambda w: F.array(w["i"], w["i"] + 1, w["i"] + 2))))
    return counted.withColumn("n_repeat_words", F.coalesce(F.size(covered), F.lit(0)).cast("long")).withColumn(
        "n_repeat_words", F.greatest("n_repeat_words", F.lit(0).cast("long"))
    ).drop("sorted")


def _share(part: str, whole: str) -> Column:
    """In whole thousandths, rounded down, so that every engine gets the same; 0 of an empty whole."""
    return F.when(F.col(whole) > 0, F.expr(f"({part} * 1000) div {whole}")).otherwise(0)


def rule_shares() -> dict[str, Column]:
    return {
        "symbols": _share("n_symbols", "word_chars"),
        "bangs": _share("n_bangs", "word_chars"),
        "repeats": _share("n_repeat_words", "n_words"),
        "dup_lines": _share("n_dup_lines", "n_lines"),
        "sameness": _share("(n_words - n_different)", "n_words"),
    }


def _log_tail(n: str, k: str, risk: float) -> Column:
    """ln P(X <= k) for X of the binomial distribution of n trials with probability ``risk``."""
    odds = F.log(F.lit(risk / (1 - risk)))
    start = F.struct((F.col(n) * F.log1p(F.lit(-risk))).alias("term"), (F.col(n) * F.log1p(F.lit(-risk))).alias("total"))

    def add(acc, i):
        term = acc["term"] + F.log((F.col(n) - i + 1) / i) + odds
        high, low = F.greatest(acc["total"], term), F.least(acc["total"], term)
        return F.struct(term.alias("term"), (high + F.log1p(F.exp(low - high))).alias("total"))

    steps = F.when(F.col(k) > 0, F.sequence(F.lit(1), F.col(k).cast("int"))).otherwise(F.array().cast("array<int>"))
    return F.aggregate(steps, start, add)["total"]


def stratum(lang: Column) -> Column:
    return F.when(lang.isin(*STRATA), lang).otherwise("other")


def cutoff_steps(ranked: DataFrame, risk: float = RISK) -> DataFrame:
    """Per stratum, rule and step a cutoff; it does not rise from one step to the next.

    The first ``MARGINS`` steps divide the way from 1000 down to the highest share of the ranked
    documents. Step ``MARGINS`` + i is the lowest share above which at most i / ``LEVELS`` of
    ``risk`` of them lie. At most 1,001 rows meet in a window: shares are whole thousandths.
    """
    shares = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.col(r).alias("share")) for r in RULES]))
    counted = ranked.select("stratum", shares.alias("s")).groupBy("stratum", "s.rule", "s.share").agg(F.count("*").alias("c"))
    group = Window.partitionBy("stratum", "rule")
    higher = group.orderBy(F.desc("share")).rowsBetween(Window.unboundedPreceding, -1)
    ladder = counted.select(
        "stratum", "rule", "share", F.coalesce(F.sum("c").over(higher), F.lit(0)).alias("above"), F.sum("c").over(group).alias("n")
    )
    level = F.explode(F.sequence(F.lit(0), F.lit(LEVELS)))
    seen = (
        ladder.withColumn("level", level)
        .filter(F.col("above") <= F.col("level") * F.lit(risk / LEVELS) * F.col("n"))
        .groupBy("stratum", "rule", (F.col("level") + MARGINS).alias("step"))
        .agg(F.min("share").cast("long").alias("cutoff"))
    )
    margin = F.explode(F.sequence(F.lit(0), F.lit(MARGINS - 1)))
    tops = ladder.groupBy("stratum", "rule").agg(F.max("share").cast("long").alias("top")).withColumn("step", margin)
    looser = F.expr(f"top + ((1000 - top) * ({MARGINS} - step)) div {MARGINS + 1}")
    return seen.unionByName(tops.select("stratum", "rule", "step", looser.alias("cutoff")))


def controlled_cutoffs(holdout: DataFrame, risk: float = RISK, confidence: float = CONFIDENCE) -> DataFrame:
    """Per stratum the strictest cutoffs of all rules whose false rejections together are bounded.

    ``holdout`` holds stratum, ``ranked`` and rule shares of good labelled documents. The ranked
    ones fix a sequence of ever stricter joint cutoffs (see ``cutoff_steps``), the others test it
    in that order. A step whose cutoffs reject k of n tested documents passes if that few would
    have a probability of at most (1 - confidence) / strata were the true rate of false rejection
    ``risk``: the exact binomial bound. Rejections are nested, so the first step that fails ends
    the sequence, and no correction is due for its length; strata have Bonferroni's. 228 tested
    documents suffice where none is rejected, and 329 where one is. Where no step passes the rules reject
    nothing. Labelled documents are taken as independent draws. At most strata x rules rows.
    """
    steps = cutoff_steps(holdout.filter("ranked"), risk)
    # One row per stratum, each rule's cutoffs in the order of the steps.
    listed = F.transform(F.array_sort(F.collect_list(F.struct("step", "cutoff"))), lambda s: s["cutoff"])
    ladders = steps.groupBy(F.col("stratum").alias("of")).pivot("rule", list(RULES)).agg(listed)
    ladders = ladders.select("of", *[F.col(r).alias(f"cuts_{r}") for r in RULES])
    # The first step that rejects a document is the number of cutoffs that do not.
    first = F.least(*[F.expr(f"size(filter(cuts_{r}, cut -> {r} <= cut))") for r in RULES])
    tested = holdout.filter(~F.col("ranked")).join(F.broadcast(ladders), F.col("stratum") == F.col("of"))
    counted = tested.groupBy("stratum", first.alias("first")).agg(F.count("*").alias("c"))
    results = (
        counted.withColumn("step", F.explode(F.sequence(F.lit(0), F.lit(MARGINS + LEVELS))))
        .groupBy("stratum", "step")
        .agg(F.sum("c").alias("n"), F.sum(F.when(F.col("first") <= F.col("step"), F.col("c")).otherwise(0)).alias("k"))
        .filter(F.col("k") <= F.col("n") * risk)
    )
    limit = (1 - confidence) / (len(STRATA) + 1)
    passed = results.filter(_log_tail("n", "k", risk) <= F.log(F.lit(limit)))
    return steps.join(passed.groupBy("stratum").agg(F.max("step").alias("step")), ["stratum", "step"]).select("stratum", "rule", "cutoff")


def quality_rules(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    lang_column: str = "lang",
    risk: float = RISK,
    confidence: float = CONFIDENCE,
) -> DataFrame:
    """The rule counts of every document and whether it is kept.

    Words are runs without white space. Base rules: fewer than ``MIN_WORDS`` words, or more than
    half of the words in three-word windows that occur twice. Beyond them each rule of ``RULES``
    rejects above the cutoff that ``controlled_cutoffs`` found for the document's stratum from the
    labels (columns doc_id, quality; rows of quality 1 are good; null ids or labels are left out,
    repeated labels count once per document). No labels: the base rules alone. Null and empty
    texts have no words and fail the base. Rows equal in id and text each come back.
    """
    spread_out(docs.sparkSession)
    own = docs.select(
        F.col(id_column).alias("id"),
        stratum(F.col(lang_column)).alias("stratum"),
        F.coalesce(F.col(text_column), F.lit("")).alias("text"),
    )
    counts = written(measured(own), "rule-counts")
    base = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    scored = counts.withColumn("base_failed", base).withColumns(rule_shares())
    good = labels.filter(F.col("quality") == 1).select(F.col("doc_id").alias("id")).distinct()
    ranked = F.substring(F.md5(F.col("id").cast("string").cast("binary")), 1, 1).isin(*RANKED)
    holdout = scored.filter(~F.col("base_failed")).join(good, "id", "left_semi").withColumn("ranked", ranked)
    cutoffs = controlled_cutoffs(holdout, risk, confidence)
    # One row per stratum, at most len(STRATA) + 1.
    chosen = cutoffs.groupBy(F.col("stratum").alias("of")).pivot("rule", list(RULES)).agg(F.min("cutoff"))
    chosen = chosen.select("of", *[F.col(r).alias(f"cut_{r}") for r in RULES])
    over = [F.coalesce(F.col(r) > F.col(f"cut_{r}"), F.lit(False)) for r in RULES]
    rejected = over[0]
    for one in over[1:]:
        rejected = rejected | one
    return scored.join(F.broadcast(chosen), F.col("stratum") == F.col("of"), "left").select(
        F.col("id").alias(id_column),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        (~F.col("base_failed") & ~rejected).alias("kept"),
    )


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


_SHARES = """
    SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
           CASE WHEN word_chars > 0 THEN n_symbols * 1000 // word_chars ELSE 0 END AS symbols,
           CASE WHEN word_chars > 0 THEN n_bangs * 1000 // word_chars ELSE 0 END AS bangs,
           CASE WHEN n_words > 0 THEN n_repeat_words * 1000 // n_words ELSE 0 END AS repeats,
           CASE WHEN n_lines > 0 THEN n_dup_lines * 1000 // n_lines ELSE 0 END AS dup_lines,
           CASE WHEN n_words > 0 THEN (n_words - n_different) * 1000 // n_words ELSE 0 END AS sameness
    FROM counts
"""

OP7_SQL = rf"""
WITH w AS (
    SELECT doc_id, CASE WHEN lang IN ('en', 'de', 'fr', 'es') THEN lang ELSE 'other' END AS stratum,
           coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws,
           [l FOR l IN string_split(coalesce(text, ''), chr(10)) IF regexp_matches(l, '[^\x20\x09-\x0D]')] AS ls
    FROM documents
), grams AS (
    SELECT doc_id, s, count(*) OVER (PARTITION BY doc_id, ws[s], ws[s + 1], ws[s + 2]) AS c
    FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS s FROM w WHERE len(ws) >= 3)
), repeated AS (
    SELECT doc_id, count(DISTINCT s + k) AS n FROM grams, (SELECT unnest([0, 1, 2]) AS k) WHERE c > 1 GROUP BY doc_id
), counts AS (
    SELECT w.doc_id, stratum, len(ws)::BIGINT AS n_words,
           length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
           length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
           length(regexp_replace(t, '[^!]', '', 'g'))::BIGINT AS n_bangs,
           len(list_distinct(ws))::BIGINT AS n_different, len(ls)::BIGINT AS n_lines,
           (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(r.n, 0)::BIGINT AS n_repeat_words
    FROM w LEFT JOIN repeated AS r ON r.doc_id = w.doc_id
), scored AS ({_SHARES}
), shares AS (
    SELECT doc_id, stratum, substr(md5(doc_id::VARCHAR), 1, 1) IN ('0', '1', '2', '3') AS ranked, rule, share
    FROM (SELECT * FROM scored WHERE NOT base_failed AND doc_id IN (SELECT doc_id FROM labels WHERE quality = 1))
    UNPIVOT (share FOR rule IN (symbols, bangs, repeats, dup_lines, sameness))
), ladder AS (
    SELECT stratum, rule, share, sum(c) OVER (PARTITION BY stratum, rule) AS n,
           coalesce(sum(c) OVER (PARTITION BY stratum, rule ORDER BY share DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS above
    FROM (SELECT stratum, rule, share, count(*) AS c FROM shares WHERE ranked GROUP BY ALL)
), steps AS (
    SELECT stratum, rule, {MARGINS} + level AS step, min(share) AS cutoff
    FROM ladder, (SELECT unnest(range(0, {LEVELS} + 1)) AS level)
    WHERE above <= level * {RISK / LEVELS!r}::DOUBLE * n GROUP BY ALL
    UNION ALL
    SELECT stratum, rule, step, top + ((1000 - top) * ({MARGINS} - step)) // {MARGINS + 1} AS cutoff
    FROM (SELECT stratum, rule, max(share) AS top FROM ladder GROUP BY ALL), (SELECT unnest(range(0, {MARGINS})) AS step)
), tested AS (
    SELECT stratum, step, count(DISTINCT doc_id) AS n, count(DISTINCT doc_id) FILTER (WHERE share > cutoff) AS k
    FROM shares JOIN steps USING (stratum, rule) WHERE NOT ranked GROUP BY stratum, step
), passed AS (
    SELECT stratum, max(step) AS step FROM tested
    WHERE k <= n * {RISK!r} AND list_sum(list_transform(range(0, k + 1), lambda i: exp(
              lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({RISK!r}) + (n - i) * ln(1 - {RISK!r}))))
          <= {(1 - CONFIDENCE) / (len(STRATA) + 1)!r}
    GROUP BY stratum
), chosen AS (
    SELECT stratum, rule, cutoff FROM steps JOIN passed USING (stratum, step)
), verdicts AS (
    SELECT DISTINCT doc_id FROM scored AS s JOIN chosen AS c ON c.stratum = s.stratum
    WHERE (rule = 'symbols' AND symbols > cutoff) OR (rule = 'bangs' AND bangs > cutoff) OR (rule = 'repeats' AND repeats > cutoff)
       OR (rule = 'dup_lines' AND dup_lines > cutoff) OR (rule = 'sameness' AND sameness > cutoff)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND doc_id NOT IN (SELECT doc_id FROM verdicts) AS kept
FROM scored
"""
