"""Corpus pipeline: each stage reads what its predecessor kept, and all but the last return documents.

toxicity          documents that score toxic go
exact dedup       of equal texts the longest, then the smallest doc_id stays
near dedup        one document of each group of similar five-word shingle sets (Jaccard 0.8) stays
decontamination   documents with words of a benchmark passage go
packing           what is left, packed into sequences of at most 4096 tokens
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from opsward.llm.common import store, table
from opsward.llm.decontamination import drop_contaminated
from opsward.llm.exact_dedup import drop_exact_duplicates
from opsward.llm.jaccard_join import drop_near_duplicates
from opsward.llm.packing import pack
from opsward.llm.toxicity import drop_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_exact_duplicates(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: A learned lexicon and token ids are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), f"stage-{name}")
    name, stage = STAGES[-1]
    return stage(spark, docs, sf_dir)
