"""Registered queries of the training-data operators, one per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from quarry.llm import (
    centroid_clusters,
    embedding_dedup,
    html_wrapper,
    language_id,
    license_scan,
    packing,
    quality,
    secret_scan,
    sentencepiece_bpe,
    setsketch,
    source_divergence,
    substring_dedup,
    toxicity,
)
from quarry.session import table_path

Builder = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[Builder, str | None]] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Builder) -> Builder:
        REGISTRY[name] = (fn, sql)
        return fn
    return deco


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


@register("op1_sentencepiece")
def op1_sentencepiece(spark, sf_dir):
    return sentencepiece_bpe.digests(_table(spark, sf_dir, "documents"),
                                     public_tokenizers.path("piece_bpe_32k.model"))


@register("op3_embedding_near_dedup")
def op3_embedding_near_dedup(spark, sf_dir):
    return embedding_dedup.near_duplicates(_table(spark, sf_dir, "embeddings"))


@register("op4_secret_scan")
def op4_secret_scan(spark, sf_dir):
    return secret_scan.scan(_table(spark, sf_dir, "documents"))


@register("op5_quality_rules")
def op5_quality_rules(spark, sf_dir):
    return quality.quality(_table(spark, sf_dir, "documents"))


@register("op6_language_id")
def op6_language_id(spark, sf_dir):
    return language_id.identify(_table(spark, sf_dir, "documents"))


@register("op7_toxicity")
def op7_toxicity(spark, sf_dir):
    return toxicity.toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


@register("op8_minhash_near_dedup")
def op8_minhash_near_dedup(spark, sf_dir):
    return setsketch.groups(_table(spark, sf_dir, "documents"))


@register("op9_best_fit_packing")
def op9_best_fit_packing(spark, sf_dir):
    return packing.pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@register("op2_html_extraction")
def op2_html_extraction(spark, sf_dir):
    return html_wrapper.extract(_table(spark, sf_dir, "pages"))


@register("op10_license_scan")
def op10_license_scan(spark, sf_dir):
    return license_scan.scan(_table(spark, sf_dir, "documents"))


@register("op11_substring_dedup", substring_dedup.ORACLE_SQL)
def op11_substring_dedup(spark, sf_dir):
    return substring_dedup.digests(_table(spark, sf_dir, "documents"))


@register("op12_centroid_clustering", centroid_clusters.oracle_sql())
def op12_centroid_clustering(spark, sf_dir):
    return centroid_clusters.cluster(_table(spark, sf_dir, "embeddings"))


@register("op13_source_divergence", source_divergence.ORACLE_SQL)
def op13_source_divergence(spark, sf_dir):
    return source_divergence.audit(_table(spark, sf_dir, "documents"))
