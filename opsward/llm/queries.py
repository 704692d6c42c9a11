"""Registered queries of the training-data operators, each over whole tables, with SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    decontamination, exact_dedup, hard_negatives, html_extraction, jaccard_join, kneser_ney, language_id, line_chunks, line_runs, packing,
    periodic_runs, quality, token_files, toxicity,
)
from .common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(build):
        QUERIES[name] = build
        if oracle:
            ORACLES[name] = oracle
        return build

    return register


@query("op2_exact_dedup", exact_dedup.ORACLE)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


@query("op10_line_chunks", line_chunks.ORACLE)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_chunks.dedupe_lines(table(spark, sf_dir, "documents"))


@query("op10_line_runs", line_runs.ORACLE)
def op10_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_runs.dedupe_line_runs(table(spark, sf_dir, "documents"))


@query("op1_token_files")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = token_files.write_token_files(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return token_files.read_token_files(manifest)


@query("op6_packing")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query("op9_decontamination", decontamination.ORACLE)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op3_toxicity")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op5_quality")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op8_language_id")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.predict_languages(table(spark, sf_dir, "documents"))


@query("op4_jaccard_join")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(table(spark, sf_dir, "documents"))


@query("op7_kneser_ney")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kneser_ney.score(table(spark, sf_dir, "documents"))


@query("op11_hard_negatives", hard_negatives.ORACLE)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0, moved)


@query("op12_periodic_runs")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.digests(periodic_runs.periodic_runs(table(spark, sf_dir, "documents"), prepare=periodic_runs.planted))


@query("op13_html_extraction")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extraction.extract_main_text(table(spark, sf_dir, "pages"))
