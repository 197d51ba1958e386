"""The queries of this package and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from salesloom.llm import (
    co_training,
    conversation_repair,
    line_dedup,
    merkle,
    minhash_forest,
    mixing,
    packing,
    paragraph_dedup,
    quality_rules,
    suffix_dedup,
    toxicity,
    warc,
    winnowing,
)

Query = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Query]:
    return {
        "op1_best_fit_packing": packing.op1_best_fit_packing,
        "op2_ngram_jaccard_join": minhash_forest.op2_ngram_jaccard_join,
        "op3_suffix_array_dedup": suffix_dedup.op3_suffix_array_dedup,
        "op4_quality_classifier": co_training.op4_quality_classifier,
        "op5_line_dedup": line_dedup.op5_line_dedup,
        "op6_paragraph_dedup": paragraph_dedup.op6_paragraph_dedup,
        "op7_quality_rules": quality_rules.op7_quality_rules,
        "op8_toxicity": toxicity.op8_toxicity,
        "op9_benchmark_decontamination": winnowing.op9_benchmark_decontamination,
        "op10_warc": warc.op10_warc,
        "op11_source_mixing": mixing.op11_source_mixing,
        "op12_merkle_manifest": merkle.op12_merkle_manifest,
        "op13_conversation_repair": conversation_repair.op13_conversation_repair,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_ngram_jaccard_join": minhash_forest.OP2_SQL,
        "op5_line_dedup": line_dedup.OP5_SQL,
        "op7_quality_rules": quality_rules.OP7_SQL,
        "op9_benchmark_decontamination": winnowing.OP9_SQL,
        "op10_warc": warc.OP10_SQL,
        "op12_merkle_manifest": merkle.OP12_SQL,
    }
