"""A corpus pipeline: toxicity, SimHash near-dedup, substring dedup, decontamination, BPE."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from provlake.llm import op2_bpe, op3_substring, op4_simhash, op9_decontaminate, op10_toxicity
from provlake.llm.common import cut, settled, table, written

STAGES = [
    ("toxicity", op10_toxicity.stage),
    ("simhash_near_dedup", op4_simhash.stage),
    ("substring_dedup", op3_substring.stage),
    ("benchmark_decontamination", op9_decontaminate.stage),
    ("bpe_encoding", op2_bpe.stage),
]

#: Several stages (trained trees, component search, a tokenizer) are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``; each one's result is written and read again, and what led to it deleted."""
    docs, start = table(spark, sf_dir, "documents"), written()
    for name, stage in STAGES:
        docs = settled(spark, start, cut(stage(spark, docs, sf_dir), f"pipeline-{name}"))
    return docs
