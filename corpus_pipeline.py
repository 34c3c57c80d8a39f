"""From raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and calls one llm operator on all that
its predecessor kept; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from pricelake.llm import exact_dedup, jaccard_join, language_id, mixing, packing
from pricelake.llm.common import materialize


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter or with a narrow margin between languages go."""
    return language_id.accepted(docs)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (white space aside) the smallest doc_id stays."""
    return exact_dedup.deduplicated(docs, exact_dedup.later_half(docs))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of 0.75-similar shingle sets stays."""
    return jaccard_join.representatives(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeat, or go, until each source has its share of words."""
    return mixing.mixed(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 4096 tokens, placed in as few sequences as possible."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("language_id", identify_language), ("exact_dedup", drop_exact_copies),
          ("ngram_jaccard_join", drop_near_copies), ("mixing", mix_sources), ("best_fit_packing", pack_sequences)]

# Compression, iterated weights and tokenizers are beyond SQL; tests/llm has a brute-force run.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
