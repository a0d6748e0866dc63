"""Readers for the driver's parquet tables and their retrieval roles.

Only the columns a role needs are selected, so the scan's ReadSchema is
pruned (``documents`` carries lang/source/n_chars that retrieval never reads).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def spread(df: DataFrame, key: str) -> DataFrame:
    """Hash-partition ``df`` on ``key`` only if its scan is narrower than the cluster.

    A small source in one row group scans as a single task, and the costly
    per-row work fused into the scan (tokenizing) would run on one core. A
    large source already has one split per row group and is left alone --
    no shuffle of the raw text at scale. Hashing on the unique id keeps the
    spread deterministic under task retries.
    """
    want = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(want, key) if df.rdd.getNumPartitions() < want else df


def passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, text) from ``documents``."""
    return spread(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, text) from ``pages``: raw HTML indexed as passages (tags are tokens too)."""
    return spread(table(spark, sf_dir, "pages").select(F.col("page_id").alias("doc_id"),
                                                       F.col("html").alias("text")), "doc_id")


def keyword_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(qid, text) from ``benchmark``: each item is one keyword query."""
    return table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("qid"), "text")


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, embedding) from ``embeddings``."""
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), "embedding")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels").select("doc_id", "quality")
