"""From raw documents to packed training sequences, stage by stage.

Each stage reads what its predecessor kept, as a table written in the shared folder, and returns
the columns of ``documents``; the last returns packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from salesloom.llm import co_training, line_dedup, minhash_forest, packing, winnowing
from salesloom.llm.common import table, written

STAGES = [
    ("quality_classifier", co_training.stage),
    ("line_dedup", line_dedup.stage),
    ("ngram_jaccard_join", minhash_forest.stage),
    ("benchmark_decontamination", winnowing.stage),
    ("best_fit_packing", packing.stage),
]

# The classifier and the packing can't be stated in SQL. Tests compare the near-duplicate stage with brute force;
# of the others they check columns, counts and what stays.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``, each to the written result of the one before."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
