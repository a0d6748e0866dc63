"""Approximate nearest-neighbour search with an inverted file of cells.

Build: pick ``n_cells`` centroids (``train='kmeans'``: MLlib k-means, the
default; ``train='pivots'``: the vectors with the smallest ids, a reproducible
mode for tests), then store every vector in its ``assign_k`` best cells.
Without ``n_cells`` there are about sqrt(rows) of them. Search: every query
probes its ``nprobe`` best cells; more cells probed (or more cells per vector)
means better recall and more work -- the same trade-off as the graph index's
search/connectivity knobs.

The centroid table is bounded by ``n_cells``: it is collected once and shipped
to every executor as one broadcast variable, and cell choice is a matrix
product per Arrow batch that returns cell numbers only. A search is one
cogroup per cell and block: a cell's vectors, in blocks of ``CELL_BYTES`` bytes,
meet the queries that probe it, in blocks of ``QUERY_BLOCK`` rows, in one
matrix product that keeps k rows per query. No pair is ever a row, and a cell
that holds a third of all vectors is many blocks.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from quarry.operators import metrics as M
from quarry.operators.knn import PAIR_SCHEMA, keep_best, merged_topk, pair_kernel
from quarry.operators.vector_tree import sampled
from quarry.session import bounded_broadcast, materialize, scratch_path, ship_package

CELL_BYTES = 32 << 20 # vectors of a cell in one matrix product
SAMPLE_ROWS = 1 << 18 # vectors that k-means is trained on, at most
QUERY_BLOCK = 4096    # queries in one matrix product
MAX_CELLS = 1 << 16   # centroids, at most, where their number follows the rows


def pivot_centroids(vectors: DataFrame, n_cells: int) -> DataFrame:
    """(cell_id, centroid): the ``n_cells`` vectors with the smallest ids.

    ``orderBy().limit()`` plans as a per-partition top-n merged once; the
    numbering then runs over ``n_cells`` rows only.
    """
    piv = vectors.select("id", "embedding").orderBy("id").limit(n_cells)
    w = Window.orderBy("id")
    return piv.select((F.row_number().over(w) - 1).cast("bigint").alias("cell_id"),
                      F.col("embedding").alias("centroid"))


def kmeans_centroids(vectors: DataFrame, n_cells: int, iters: int = 20, seed: int = 7,
                     sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """(cell_id, centroid) from MLlib k-means (k-means|| init) on at most about ``sample_rows`` vectors, by a hash of the id."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    train = sampled(vectors, vectors.count(), sample_rows, seed)
    feats = train.select(array_to_vector("embedding").alias("features"))
    model = KMeans(k=n_cells, maxIter=iters, seed=seed, featuresCol="features").fit(feats)
    spark = vectors.sparkSession
    rows = [(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())]
    return spark.createDataFrame(rows, "cell_id BIGINT, centroid ARRAY<FLOAT>")


def centroid_matrix(centroids: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(cell ids, n_cells x d float64 matrix), ordered by cell id.

    Collected to the driver on purpose: the table has ``n_cells`` rows, a
    build parameter, never a data-dependent size.
    """
    rows = centroids.select("cell_id", "centroid").orderBy("cell_id").collect()
    ids = np.array([r["cell_id"] for r in rows], dtype=np.int64)
    mat = np.array([np.asarray(r["centroid"], dtype=np.float64) for r in rows])
    return ids, mat


def with_nearest_cells(df: DataFrame, vec_col: str, centroids: DataFrame, n: int,
                       out_col: str = "cells") -> DataFrame:
    """Add ``out_col``: the ``n`` best cell ids by inner product (ties: smaller cell id; none for a null vector).

    The centroid matrix travels once per executor as a broadcast variable;
    each Arrow batch of rows is scored against it with one matrix product.
    """
    spark = df.sparkSession
    ship_package()
    ids, mat = centroid_matrix(centroids)
    bc = spark.sparkContext.broadcast((ids, mat))
    schema = StructType(df.schema.fields + [StructField(out_col, ArrayType(LongType()))])
    return df.mapInArrow(_cells_kernel(bc, df.columns.index(vec_col), out_col, n), schema)


CELL_SCORES = 1 << 22  # score-matrix entries per chunk of rows (32 MB of doubles)


def _cells_kernel(bc, at: int, out_col: str, n: int):
    def run(batches):
        ids, mat = bc.value
        step = max(1, CELL_SCORES // max(1, len(ids)))
        for batch in batches:
            vectors = batch.column(at)
            full = np.asarray(vectors.is_valid())
            x = vectors.drop_null().flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            x = x.reshape(int(full.sum()), mat.shape[1])
            chosen = [np.zeros((0, min(n, len(ids))), np.int64)]
            for lo in range(0, len(x), step):
                s = x[lo:lo + step] @ mat.T
                cells = np.broadcast_to(ids, s.shape)
                if s.shape[1] > n:
                    # n best cells (score desc, ties to the smaller cell id)
                    s, cells = keep_best(s, cells, n)
                chosen.append(cells)
            cells = np.concatenate(chosen)
            offsets = np.concatenate([[0], np.cumsum(full * cells.shape[1])]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(cells.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], names=[*batch.schema.names, out_col])
    return run


def assign(vectors: DataFrame, centroids: DataFrame, assign_k: int = 1) -> DataFrame:
    """(cell_id, id, embedding): each vector in its ``assign_k`` best cells."""
    return (with_nearest_cells(vectors.select("id", "embedding"), "embedding", centroids, assign_k)
            .select(F.explode("cells").alias("cell_id"), "id", "embedding"))


@dataclass
class VectorIndex:
    centroids: DataFrame          # (cell_id, centroid)
    assignment: DataFrame         # (cell_id, id, embedding)
    params: dict = field(default_factory=dict)

    @classmethod
    def build(cls, vectors: DataFrame, n_cells: int | None = None, train: str = "kmeans", iters: int = 20,
              assign_k: int = 1, seed: int = 7, sample_rows: int = SAMPLE_ROWS,
              path: str | None = None) -> "VectorIndex":
        """Train the cells and write centroids and assignment once, in the saved
        layout (cells partitioned by ``cell_id``): at ``path`` if given -- a
        later ``save(path)`` then only adds the parameters -- else below the
        shared checkpoint folder. Searches and statistics read that copy."""
        if n_cells is None:
            n_cells = min(MAX_CELLS, max(1, math.isqrt(vectors.count())))
        if n_cells <= 0 or assign_k <= 0 or assign_k > n_cells:
            raise ValueError("need n_cells > 0 and 0 < assign_k <= n_cells")
        if train == "pivots":
            cents = pivot_centroids(vectors, n_cells)
        elif train == "kmeans":
            cents = kmeans_centroids(vectors, n_cells, iters, seed, sample_rows)
        else:
            raise ValueError(f"train must be 'pivots' or 'kmeans', got {train!r}")
        spark = vectors.sparkSession
        where = path or scratch_path(spark, "vector-index")
        cents.write.mode("overwrite").parquet(f"{where}/centroids")
        cents = spark.read.parquet(f"{where}/centroids")
        _write_cells(assign(vectors, cents, assign_k), where)
        return cls(cents, _cells(spark, where),
                   {"n_cells": n_cells, "train": train, "iters": iters, "assign_k": assign_k,
                    "seed": seed, "path": where})

    def search(self, queries: DataFrame, k: int, nprobe: int = 1) -> DataFrame:
        """Run (qid, pid, rank, score) for queries (qid, embedding)."""
        if k <= 0 or nprobe <= 0:
            raise ValueError("k and nprobe must be positive")
        # (qid, cell) rows are few numbers each; the query vectors are joined to them by id
        probes = (with_nearest_cells(queries.select("qid", F.col("embedding").alias("q")), "q",
                                     self.centroids, nprobe)
                  .select("qid", "q", F.explode("cells").alias("cell_id")))
        probed = materialize(probes, "probes")
        # a filtered broadcast side: the scan reads the probed cells' files only
        cells = bounded_broadcast(probed.select("cell_id").distinct().where("cell_id >= 0"))
        n_q = probed.groupBy("cell_id").agg(F.ceil(F.count(F.lit(1)) / QUERY_BLOCK).cast("int").alias("qbs"))
        rows = F.ceil(F.sum(8 * F.size("embedding").cast("bigint")) / CELL_BYTES)
        n_v = self.assignment.join(cells, "cell_id").groupBy("cell_id").agg(rows.cast("int").alias("vbs"))
        blocks = materialize(n_q.join(n_v, "cell_id"), "cell-blocks")        # at most one row per cell
        blocks = bounded_broadcast(blocks.where("vbs > 0"))
        own = lambda c, n: F.pmod(F.xxhash64(c), F.col(n)).cast("int")
        every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
        q = probed.join(blocks, "cell_id").select("cell_id", "qid", F.col("q").alias("query"),
                                                  own("qid", "qbs").alias("qb"), every("vbs").alias("vb"))
        p = self.assignment.join(blocks, "cell_id").select("cell_id", "id", "embedding",
                                                           own("id", "vbs").alias("vb"), every("qbs").alias("qb"))
        keys = ["cell_id", "vb", "qb"]
        pairs = p.groupBy(*keys).cogroup(q.groupBy(*keys)).applyInArrow(pair_kernel(k), PAIR_SCHEMA)
        if int(self.params.get("assign_k", 1)) > 1:
            # a passage found in several of its cells: at most assign_k rows of each are in some block's best k
            pairs = pairs.groupBy("qid", "pid").agg(F.max("score").alias("score"))
        return merged_topk(pairs, k)

    def stats(self) -> DataFrame:
        """One row: vectors, stored entries, dimension, cells used, cell occupancy."""
        occ = self.assignment.groupBy("cell_id").agg(F.count(F.lit(1)).alias("n"))
        cells = occ.agg(F.struct(F.count(F.lit(1)).alias("used"), F.min("n").alias("lo"),
                                 F.max("n").alias("hi")).alias("s")).scalar()   # one subquery
        return self.assignment.agg(
            F.countDistinct("id").alias("n_vectors"),
            F.count(F.lit(1)).alias("n_entries"),
            F.max(F.size("embedding")).cast("bigint").alias("dim"),
            F.lit(int(self.params.get("n_cells", 0))).cast("bigint").alias("n_cells"),
            F.first(cells["used"]).alias("cells_used"),
            F.first(cells["lo"]).alias("min_cell"),
            F.first(cells["hi"]).alias("max_cell"))

    def save(self, path: str) -> None:
        spark = self.centroids.sparkSession
        if self.params.get("path") != path:
            self.centroids.write.mode("overwrite").parquet(f"{path}/centroids")
            _write_cells(self.assignment, path)
        params = {**self.params, "path": path}
        spark.createDataFrame([(k, str(v)) for k, v in params.items()],
                              "key string, value string").coalesce(1) \
            .write.mode("overwrite").parquet(f"{path}/params")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "VectorIndex":
        raw = {r["key"]: r["value"] for r in spark.read.parquet(f"{path}/params").collect()}
        params = {k: (v if k in ("train", "path") else int(v)) for k, v in raw.items()}
        params["path"] = path
        return cls(spark.read.parquet(f"{path}/centroids"), _cells(spark, path), params)


def _write_cells(assignment: DataFrame, path: str) -> None:
    """Cells partitioned by ``cell_id``; rows are gathered by cell first, a large cell over many files."""
    parts = int(assignment.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (assignment.repartitionByRange(parts, "cell_id", F.xxhash64("id"))
     .write.mode("overwrite").partitionBy("cell_id").parquet(f"{path}/cells"))


def _cells(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/cells").select(
        F.col("cell_id").cast("bigint"), "id", "embedding")


def ann_recall(approx: DataFrame, exact: DataFrame, k: int) -> DataFrame:
    """(metric='recall', k, value): share of the exact top k the approximate run finds."""
    truth = M.truncate_run(exact, k).select("qid", "pid", F.lit(1).alias("rel"))
    per = M.per_query_metrics(approx, truth, k)
    return M.aggregate_metric(per, "recall", k)
