"""Support questions: best FAQ entry, tickets, summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesloom import fixed_values as fv
from salesloom.functions.ids import row_id
from salesloom.functions.numbers import rounded
from salesloom.functions.text import or_label, word_set
from salesloom.operators.joins import shuffled_join
from salesloom.operators.matching import overlap_search


def match_faq(
    questions: DataFrame,
    faq: DataFrame,
    min_score: int = fv.FAQ_MIN_SCORE,
    pattern: str = fv.FAQ_TOKEN_PATTERN,
    stop_words: Sequence[str] = fv.FAQ_STOP_WORDS,
) -> DataFrame:
    """Best FAQ entry per question by the number of shared words, with its answer; ties go to the lower id.

    A shared word is enough for an answer, but below ``min_score`` an operator is needed
    too. Questions with the same words are looked up once, in one plan for any size: a common word
    makes no pairs of questions and entries (see ``overlap_search``). Answers are looked up for the best entries only.
    """
    text = F.concat_ws(" ", "question", "answer", "category")
    entries = faq.select(F.col("item_id").alias("entry"), word_set(text, pattern, stop_words).alias("words"))
    asked = questions.select("question_id", F.sort_array(word_set("question", pattern, stop_words)).alias("words"))
    asked = asked.select("question_id", F.sha2(F.array_join("words", " "), 256).alias("set_id"), "words")
    sets = asked.groupBy("set_id").agg(F.first("words").alias("words"))
    found = overlap_search(sets, entries).best().withColumnRenamed("entry", "item_id")
    best = shuffled_join(asked.select("question_id", "set_id"), found, "set_id").drop("set_id")
    best = best.join(faq.select("item_id", "intent", "category", "answer"), "item_id")
    score = F.coalesce("score", F.lit(0))
    return questions.select("question_id").distinct().join(best, "question_id", "left").select(
        "question_id",
        F.col("item_id").isNotNull().alias("found"),
        "item_id",
        F.coalesce("intent", F.lit(fv.UNKNOWN_INTENT)).alias("intent"),
        "category",
        F.when(F.col("item_id").isNull(), fv.UNKNOWN_ANSWER).otherwise(F.col("answer")).alias("answer"),
        score.alias("score"),
        (score < min_score).alias("need_operator"),
    )


def support_tickets(questions: DataFrame, matches: DataFrame) -> DataFrame:
    """A ticket per question; the request for an operator is an intent of its own."""
    joined = questions.join(matches.select("question_id", "intent", "need_operator"), "question_id", "left")
    asks_operator = F.lower("question") == fv.OPERATOR_PHRASE
    need = F.coalesce(asks_operator, F.lit(False)) | F.coalesce("need_operator", F.lit(True))
    intent = F.when(asks_operator, fv.OPERATOR_INTENT).otherwise(F.coalesce("intent", F.lit(fv.UNKNOWN_INTENT)))
    return joined.select(
        row_id("T", "created_at", "question_id").alias("ticket_id"),
        "question_id",
        "created_at",
        or_label("client_name", fv.DEFAULT_CLIENT).alias("client_name"),
        "channel",
        F.trim(F.coalesce("question", F.lit(""))).alias("question"),
        intent.alias("detected_intent"),
        F.when(need, "operator").otherwise("answered").alias("status"),
        need.cast("int").alias("need_operator"),
    )


def support_daily(tickets: DataFrame) -> DataFrame:
    grouped = tickets.groupBy(F.to_date("created_at").alias("date"), "detected_intent", "status").agg(
        F.count(F.lit(1)).alias("tickets"), rounded(F.avg("need_operator") * 100, 1).alias("operator_share")
    )
    return grouped.orderBy(F.col("date").desc(), F.col("tickets").desc(), "detected_intent", "status")


def support_summary(tickets: DataFrame) -> DataFrame:
    grouped = tickets.dropna(subset=["detected_intent", "status"]).groupBy("detected_intent", "status").agg(
        F.count("ticket_id").alias("tickets_count"), rounded(F.avg("need_operator") * 100, 1).alias("operator_share")
    )
    return grouped.orderBy(F.col("tickets_count").desc(), "detected_intent", "status")


def operator_messages(tickets: DataFrame) -> DataFrame:
    """Text for the operator, one per ticket that needs one."""
    text = F.format_string(fv.TICKET_TEXT, "ticket_id", "client_name", "channel", "detected_intent", "question")
    return tickets.filter("need_operator = 1").select("ticket_id", text.alias("message"))
