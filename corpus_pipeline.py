"""The corpus pipeline: stages over the documents, each written as Parquet and read again by the next."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from starmill.llm import bpe, ngram_join, quality_rules, radix_dedup, source_mixing
from starmill.llm.common import save, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.keep_good(docs, table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first of each group of equal texts."""
    return radix_dedup.keep_first(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first of each group of linked texts."""
    return ngram_join.keep_first(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the target weights ask for."""
    return source_mixing.mix(docs, table(spark, sf_dir, "labels"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document that is left, and a digest of what they decode to."""
    file = public_tokenizers.path("word_bpe_49k.json")
    return bpe.encode(docs, file, ("n_tokens", "ids", "ids_sha256", "decoded_sha256"))


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", keep_good),
    ("exact_dedup", drop_copies),
    ("ngram_jaccard_join", drop_near_copies),
    ("mix_sources", mix_sources),
    ("bpe", encode),
]

# No SQL says what a trained score or a tokenizer gives; tests hold the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = save(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
