"""Exact kNN by inner product over blocks in the order of their norms.

Vectors are written once in blocks of descending norm, with each block's
largest norm. A query reads the first blocks, then every further block with
``|q| * largest norm`` at least its k-th score so far, and no other: where
norms differ, most blocks are skipped, and the result is that of exhaustive
search. Vectors of one norm are split over blocks by a hash of their id.

Null vectors are left out; ties go to the smaller id; an empty table gives an
empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators.knn import matrix_of, merged_topk
from quarry.operators.vector_tree import SLACK, barred, query_rows, read_cells
from quarry.session import materialize, scratch_path, ship_package

BLOCK_ROWS = 65_536
FIRST = 1                 # blocks that every query reads


@dataclass
class NormBlocks:
    spark: SparkSession
    path: str

    def __post_init__(self):
        self.vectors = self.spark.read.parquet(f"{self.path}/vectors") \
            .select(F.col("coarse_id").cast("int").alias("coarse_id"), F.col("coarse_id").cast("bigint").alias("cell_id"),
                    "id", "embedding")
        self.blocks = self.spark.read.parquet(f"{self.path}/blocks").orderBy("coarse_id").collect()   # rows / BLOCK_ROWS

    @classmethod
    def build(cls, vectors: DataFrame, path: str | None = None, block_rows: int = BLOCK_ROWS) -> "NormBlocks":
        if block_rows <= 0:
            raise ValueError("block_rows must be positive")
        spark = vectors.sparkSession
        path = path or scratch_path(spark, "norm-blocks")
        vectors = vectors.select("id", "embedding").filter("embedding is not null")
        norm = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x.cast("double") * x))
        n = vectors.count()
        rows = vectors.withColumn("norm", norm)
        if n:
            rows.repartitionByRange(-(-n // block_rows), F.desc("norm"), F.xxhash64("id")) \
                .withColumn("coarse_id", F.spark_partition_id()).write.mode("overwrite").partitionBy("coarse_id") \
                .parquet(f"{path}/vectors")
        else:                                               # a partitioned table without rows has no files
            rows.withColumn("coarse_id", F.lit(0)).write.mode("overwrite").parquet(f"{path}/vectors")
        written = spark.read.parquet(f"{path}/vectors")
        written.groupBy("coarse_id").agg(F.max("norm").alias("norm"), F.count("*").alias("n"),
                                         F.max(F.size("embedding")).alias("dims")) \
            .coalesce(1).write.mode("overwrite").parquet(f"{path}/blocks")
        return cls(spark, path)

    def _needed(self, queries: DataFrame) -> DataFrame:
        """(qid, coarse_id, cell_id): the blocks whose bound reaches a query's bar."""
        norms = np.array([b.norm for b in self.blocks])
        ids = np.array([b.coarse_id for b in self.blocks], np.int32)
        shared = self.spark.sparkContext.broadcast((norms, ids))

        def run(batches):
            norms, ids = shared.value
            for b in batches:
                if b.num_rows and len(ids):
                    length = np.sqrt((matrix_of(b.column(1)) ** 2).sum(axis=1))[:, None]
                    row, which = np.nonzero(length * norms * (1 + SLACK) + SLACK >= np.asarray(b.column(2))[:, None])
                    yield pa.RecordBatch.from_arrays(
                        [b.column(0).take(pa.array(row)), pa.array(ids[which]), pa.array(ids[which].astype(np.int64))],
                        names=["qid", "coarse_id", "cell_id"])

        ship_package()
        return queries.select("qid", "q", "bar").mapInArrow(run, "qid bigint, coarse_id int, cell_id bigint")

    def search_with_reads(self, queries: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
        """The run (qid, pid, rank, score) of queries (qid, embedding), and (qid, coarse_id, cell_id) of the blocks read."""
        if k <= 0:
            raise ValueError("k must be positive")
        queries, n_qb = query_rows(queries)
        top = [b.coarse_id for b in sorted(self.blocks, key=lambda b: -b.norm)[:FIRST]]
        probes = queries.select("qid", F.explode(F.array([F.lit(c) for c in top]).cast("array<int>")).alias("coarse_id")) \
            .withColumn("cell_id", F.col("coarse_id").cast("bigint"))
        dims = max([b.dims for b in self.blocks], default=1)
        read = lambda probes: read_cells(self.vectors, [(b.coarse_id, b.n) for b in self.blocks], dims,
                                         queries, probes, k, n_qb)
        first = materialize(merged_topk(read(probes), k), "norm-first")
        more = materialize(self._needed(barred(queries, first, k)).filter(~F.col("coarse_id").isin(top)), "norm-more")
        return merged_topk(first.select("qid", "pid", "score").unionByName(read(more)), k), probes.unionByName(more)

    def search(self, queries: DataFrame, k: int) -> DataFrame:
        return self.search_with_reads(queries, k)[0]
