"""Embedding tables: one row per vector, ``(id BIGINT, embedding ARRAY<FLOAT>)``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_vectors(spark: SparkSession, path: str, id_col: str = "id", vec_col: str = "embedding",
                 dim: int | None = None) -> DataFrame:
    """Load vectors from Parquet; with ``dim`` every row is checked inside the job."""
    df = spark.read.parquet(path).select(F.col(id_col).cast("bigint").alias("id"),
                                         F.col(vec_col).cast("array<float>").alias("embedding"))
    return with_dim_check(df, dim) if dim is not None else df


def with_dim_check(df: DataFrame, dim: int, vec_col: str = "embedding") -> DataFrame:
    bad = F.size(vec_col) != F.lit(dim)
    return df.withColumn(vec_col, F.when(bad, F.raise_error(F.concat(
        F.lit(f"vector dimension is not {dim} for id "), F.col("id").cast("string"))))
        .otherwise(F.col(vec_col)))


def write_vectors(df: DataFrame, path: str) -> None:
    df.select("id", "embedding").write.mode("overwrite").parquet(path)
