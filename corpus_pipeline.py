"""Corpus pipeline: documents to packed training sequences.

Quality rules and toxicity drop documents, near-duplicate groups keep one
document, secrets are masked in the text, and what is left is packed into
sequences. Each stage's result is written to the shared folder and read again
as the next one's documents.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from quarry.llm import packing, quality, secret_scan, setsketch, toxicity
from quarry.session import materialize, table_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are probably good."""
    return quality.keep_good(docs)


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic; learnt from the labelled ones among ``docs``."""
    return toxicity.keep_clean(docs, spark.read.parquet(table_path(sf_dir, "labels")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each near-duplicate group."""
    return setsketch.keep_one(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their secrets masked."""
    return secret_scan.redact(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document, with its sequence and place there."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("toxicity", toxicity_filter),
    ("minhash_near_dedup", near_dedup),
    ("secret_scan", secrets),
    ("best_fit_packing", best_fit_packing),
]

ORACLE_SQL = None   # expectation-maximisation, trained models and packing are not SQL; tested against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of ``documents`` after all stages."""
    docs = spark.read.parquet(table_path(sf_dir, "documents"))
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
