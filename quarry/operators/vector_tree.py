"""Two-level vector index with trained cells, and exact search that stops by a bound.

Build. A sample of bounded size trains the tree: k-means of a part of it gives
the coarse cells, k-means of each coarse cell's sample rows gives its fine
cells. Only the coarse centroids (about the square root of the number of
cells) are broadcast; every vector goes to its nearest coarse cell, and there,
in blocks of bounded bytes, meets that cell's fine centroids. Vectors are
written once, partitioned by coarse cell and ordered by fine cell. Each cell
is stored with its radius, the largest norm of its vectors and their number.

Search by inner product. A query ranks the coarse cells, then the fine cells
of the best ones, and reads the best of those. Two ways to stop:

* ``recall=1`` (exact): no vector of a cell with centroid c, radius r and
  largest norm m scores more than ``min(q.c + |q| r, |q| m)``. After the first
  cells a query goes on to every other cell, of any coarse cell, whose bound
  reaches its k-th score, and to no other. The result equals exhaustive
  search.
* ``recall < 1``: the numbers of cells to read were measured when the index
  was built: the exact neighbours of a bounded number of its own vectors are
  looked up in the cells' order, and the smallest numbers that find the stated
  share of them are saved with the index.

Neither the cells nor the queries of a batch pass through the driver; what is
collected is the coarse cells. A coarse cell that holds a third of all vectors
is many blocks. Null vectors are not indexed; an empty table gives an index
that finds nothing; ties go to the smaller id.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.operators.knn import (
    PAIR_SCHEMA, RunningTopK, keep_best, knn_exact, matrix_of, merged_topk, pairs_table,
)
from quarry.session import bounded_broadcast, materialize, scratch_path, ship_package

LEAF_ROWS = 4096          # vectors of a fine cell, about, in a large index
SAMPLE_ROWS = 1 << 18     # vectors that the fine cells are trained on, at most
COARSE_ROWS = 1 << 15     # of these, the ones that the coarse cells are trained on, in one task
ITERS = 10                # rounds of k-means
BLOCK_BYTES = 32 << 20    # vectors of a coarse cell that one task holds
QUERY_BLOCK = 4096        # queries that one task holds
FIRST_CELLS = 8           # fine cells that an exact search reads before it has a bound
CALIBRATION_ROWS = 256    # vectors whose exact neighbours set the numbers of cells to read
SLACK = 1e-9              # rounding of a bound, relative to the norms it comes from


VECTORS = "cell_id bigint, id bigint, embedding {kind}, dist double, far double, norm double, coarse_id int"
CELLS = "coarse_id int, cell_id bigint, centroid array<double>, radius double, norm double, n bigint, far double"
COARSE = "coarse_id int, radius double, norm double, n bigint, cells bigint, centroid array<double>"


def row_hash(seed: int) -> F.Column:
    return F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(1 << 30))


def sampled(vectors: DataFrame, n: int, bound: int, seed: int) -> DataFrame:
    """About ``bound`` of the ``n`` rows at most, by a hash of the id."""
    return vectors if n <= bound else vectors.filter(row_hash(seed) < max(1, int((1 << 30) * bound / n)))


def nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Index of the nearest centre of each row."""
    half = (centres ** 2).sum(axis=1) / 2
    step = max(1, (1 << 22) // max(1, len(centres)))
    out = [(x[at:at + step] @ centres.T - half).argmax(axis=1) for at in range(0, len(x), step)]
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def kmeans(x: np.ndarray, k: int, iters: int = ITERS, seed: int = 7) -> np.ndarray:
    """Centres of at most ``k`` non-empty clusters; the rows' order does not matter."""
    x = np.unique(x, axis=0)
    rng = np.random.default_rng(seed)
    centres = x[np.sort(rng.choice(len(x), min(k, len(x)), replace=False))]
    for _ in range(iters):
        near = nearest(x, centres)
        n = np.bincount(near, minlength=len(centres))
        order = np.argsort(near, kind="stable")
        starts = np.cumsum(n) - n
        centres = centres.copy()
        centres[n > 0] = np.add.reduceat(x[order], starts[n > 0]) / n[n > 0, None]
        if (n == 0).any():                                # empty ones start again where rows are farthest from theirs
            far = np.argsort(-((x - centres[near]) ** 2).sum(axis=1), kind="stable")[:(n == 0).sum()]
            centres[np.flatnonzero(n == 0)[:len(far)]] = x[far]
    return centres


def _lists(x: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32)), pa.array(x.ravel()))


def _trained(sample: DataFrame, k: int, seed: int) -> np.ndarray:
    """Coarse centres of a bounded sample, trained in one task."""
    def run(table: pa.Table) -> pa.Table:
        return pa.table({"centroid": _lists(kmeans(matrix_of(table["embedding"]), k, seed=seed))})

    rows = sample.withColumn("part", F.lit(0)).groupBy("part").applyInArrow(run, "centroid array<double>").collect()
    return np.array([r.centroid for r in rows])


def _coarse(vectors: DataFrame, centres: np.ndarray, blocks: np.ndarray | None = None) -> DataFrame:
    """``vectors`` with their coarse cell, distance to its centre and block."""
    shared = vectors.sparkSession.sparkContext.broadcast((centres, blocks))

    def run(batches):
        centres, blocks = shared.value
        for b in batches:
            if b.num_rows:
                x, ids = matrix_of(b.column(1)), np.asarray(b.column(0), np.int64)
                near = nearest(x, centres)
                far = np.sqrt(((x - centres[near]) ** 2).sum(axis=1))
                mixed = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)
                block = mixed % (blocks[near] if blocks is not None else np.ones(len(near))).astype(np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(near.astype(np.int32)), pa.array(block.astype(np.int32)), b.column(0), b.column(1), pa.array(far)],
                    names=["coarse_id", "block", "id", "embedding", "far"])

    ship_package()
    kind = vectors.schema["embedding"].dataType.simpleString()
    return vectors.select(F.col("id").cast("bigint"), "embedding").mapInArrow(
        run, f"coarse_id int, block int, id bigint, embedding {kind}, far double")


def _fine(sample: DataFrame, n_cells: int, n_sample: int, seed: int) -> DataFrame:
    """(coarse_id, place, centroid, rows): fine centres of each coarse cell, as many as its share of the sample."""
    def run(table: pa.Table) -> pa.Table:
        coarse = table["coarse_id"][0].as_py()
        k = max(1, round(n_cells * table.num_rows / n_sample))
        centres = kmeans(matrix_of(table["embedding"]), k, seed=seed)
        return pa.table({"coarse_id": pa.array(np.full(len(centres), coarse, np.int32)),
                         "place": pa.array(np.arange(len(centres))), "centroid": _lists(centres),
                         "rows": pa.array(np.full(len(centres), table.num_rows))})

    return sample.groupBy("coarse_id").applyInArrow(run, "coarse_id int, place bigint, centroid array<double>, rows bigint")


def _assign(vectors: DataFrame, fine: DataFrame, kind: str) -> DataFrame:
    """Every vector with its nearest fine cell, the distance to its centre and its norm."""
    schema = f"coarse_id int, cell_id bigint, id bigint, embedding {kind}, dist double, far double, norm double"

    def run(p: pa.Table, c: pa.Table) -> pa.Table:
        if not p.num_rows or not c.num_rows:
            return pa.table({"coarse_id": pa.array([], pa.int32()), "cell_id": pa.array([], pa.int64()),
                             "id": pa.array([], pa.int64()), "embedding": pa.array([], p.schema.field("embedding").type)
                             if p.num_columns else pa.array([], pa.list_(pa.float32())),
                             **{n: pa.array([], pa.float64()) for n in ("dist", "far", "norm")}})
        c = c.sort_by("cell_id")
        x, centres = matrix_of(p["embedding"]), matrix_of(c["centroid"])
        near = nearest(x, centres)
        dist = np.sqrt(((x - centres[near]) ** 2).sum(axis=1))
        return pa.table({"coarse_id": p["coarse_id"], "cell_id": pa.array(np.asarray(c["cell_id"])[near]), "id": p["id"],
                         "embedding": p["embedding"], "dist": pa.array(dist), "far": p["far"],
                         "norm": pa.array(np.sqrt((x ** 2).sum(axis=1)))})

    return vectors.groupBy("coarse_id", "block").cogroup(fine.groupBy("coarse_id", "block")).applyInArrow(run, schema)


def read_cells(vectors: DataFrame, sizes: list[tuple[int, int]], dims: int, queries: DataFrame, probes: DataFrame,
               k: int, n_qb: int) -> DataFrame:
    """Pairs (qid, pid, score): the best k of each query in each block of the cells it reads.

    ``vectors(coarse_id, cell_id, id, embedding)``, ``queries(qid, q)``, ``probes(qid, coarse_id, cell_id)``; ``sizes``
    lists the rows of each coarse cell, of which one of many rows is several blocks.
    """
    spark = vectors.sparkSession
    rows = max(1, BLOCK_BYTES // (8 * max(1, dims)))
    blocks = spark.createDataFrame([(c, -(-int(n) // rows)) for c, n in sizes], "coarse_id int, vbs int")
    wanted = probes.groupBy("qid", "coarse_id").agg(F.collect_list("cell_id").alias("cells"))   # of one coarse cell
    q = wanted.join(queries.select("qid", "q"), "qid").join(F.broadcast(blocks), "coarse_id") \
        .select("coarse_id", "qid", "q", "cells", F.pmod(F.xxhash64("qid"), F.lit(n_qb)).cast("int").alias("qb"),
                F.explode(F.sequence(F.lit(0), F.col("vbs") - 1)).alias("vb"))
    needed = bounded_broadcast(probes.select("coarse_id", "cell_id").distinct())
    p = vectors.select("coarse_id", "cell_id", "id", "embedding").join(needed, ["coarse_id", "cell_id"]) \
        .join(F.broadcast(blocks), "coarse_id") \
        .select("coarse_id", "cell_id", "id", "embedding",
                F.pmod(F.xxhash64("id"), F.col("vbs")).cast("int").alias("vb"),
                F.explode(F.sequence(F.lit(0), F.lit(n_qb - 1))).alias("qb"))

    def run(p: pa.Table, q: pa.Table) -> pa.Table:
        if not p.num_rows or not q.num_rows:
            return pairs_table([], [], [])
        cells, cell_of = np.unique(np.asarray(p["cell_id"]), return_inverse=True)
        lists = q["cells"].combine_chunks()
        size, asked = np.diff(np.asarray(lists.offsets)), np.asarray(lists.flatten())
        at = np.minimum(np.searchsorted(cells, asked), len(cells) - 1)
        row = np.repeat(np.arange(q.num_rows), size)
        here = cells[at] == asked
        reads = np.zeros((q.num_rows, len(cells)), bool)
        reads[row[here], at[here]] = True
        best = RunningTopK(np.asarray(q["qid"], np.int64), matrix_of(q["q"]), k)
        best.add(np.asarray(p["id"], np.int64), matrix_of(p["embedding"]), (reads, cell_of))
        return best.table()

    ship_package()
    keys = ["coarse_id", "vb", "qb"]
    return p.groupBy(*keys).cogroup(q.groupBy(*keys)).applyInArrow(run, PAIR_SCHEMA)


def query_rows(queries: DataFrame) -> tuple[DataFrame, int]:
    """(qid, q, bar) of a batch, written once, and its number of query blocks."""
    rows = materialize(queries.select(
        F.col("qid").cast("bigint").alias("qid"), F.col("embedding").cast("array<double>").alias("q"),
        F.lit(float("-inf")).alias("bar")).filter("q is not null"), "vector-queries")
    return rows, max(1, -(-rows.count() // QUERY_BLOCK))


def barred(queries: DataFrame, first: DataFrame, k: int) -> DataFrame:
    """``queries`` with the k-th score of a first run as their bar, if it has k rows."""
    bars = first.filter(F.col("rank") == k).select("qid", F.col("score").alias("at_k"))
    return queries.join(bars, "qid", "left").select("qid", "q", F.coalesce("at_k", "bar").alias("bar"))


@dataclass
class VectorTree:
    """A saved index: ``coarse`` cells, fine ``cells`` and ``vectors``, all below ``path``."""

    spark: SparkSession
    path: str
    params: dict = field(default_factory=dict)

    def __post_init__(self):
        read = lambda schema, name: self.spark.read.schema(schema).parquet(f"{self.path}/{name}")
        self.cells = read(CELLS, "cells")
        self.vectors = read(VECTORS.format(kind=self.params["kind"]), "vectors")
        self.coarse = sorted(read(COARSE, "coarse").collect())                # about sqrt(cells) rows

    # -------------------------------------------------------------- build

    @classmethod
    def build(cls, vectors: DataFrame, path: str | None = None, n_cells: int | None = None,
              sample_rows: int = SAMPLE_ROWS, seed: int = 7,
              calibrate: tuple[tuple[int, float], ...] = ()) -> "VectorTree":
        """Train, assign and write. ``calibrate`` lists (k, recall) to measure numbers of cells for."""
        spark = vectors.sparkSession
        path = path or scratch_path(spark, "vector-tree")
        ship_package()
        vectors = vectors.select("id", "embedding").filter("embedding is not null")
        kind = vectors.schema["embedding"].dataType.simpleString()
        n = vectors.count()
        sample = vectors if n <= sample_rows else materialize(sampled(vectors, n, sample_rows, seed), "tree-sample")
        n_sample = n if n <= sample_rows else sample.count()
        if n_cells is not None and n_cells <= 0:
            raise ValueError("n_cells must be positive")
        n_cells = n_cells or max(1, min(max(math.isqrt(n), n // LEAF_ROWS), max(1, sample_rows // 16)))
        centres = _trained(sampled(sample, n_sample, COARSE_ROWS, seed + 1), max(1, math.isqrt(n_cells)), seed) \
            if n_sample else np.zeros((0, 1))
        dims = centres.shape[1]
        if n_sample:
            trained = materialize(_fine(_coarse(sample, centres), n_cells, n_sample, seed), "tree-fine")
            share = {r.coarse_id: r.rows / n_sample
                     for r in trained.groupBy("coarse_id").agg(F.first("rows").alias("rows")).collect()}
            used = sorted(share)                          # a centre that no sample row is nearest to is dropped
            centres = centres[used]
            blocks = np.array([math.ceil(1.25 * share[c] * n * 8 * dims / BLOCK_BYTES) for c in used], np.int64)
            numbers = spark.createDataFrame([(c, i, int(blocks[i])) for i, c in enumerate(used)],
                                            "coarse_id int, number int, blocks int")
            # numbers of the centres that are left; each block of a coarse cell gets all its fine centres
            fine = trained.join(F.broadcast(numbers), "coarse_id") \
                .select(F.col("number").alias("coarse_id"),
                        (F.col("number").cast("bigint") * (1 << 32) + F.col("place")).alias("cell_id"), "centroid", "blocks")
            dealt = fine.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks")
            stored = _assign(_coarse(vectors, centres, blocks), dealt, kind)
        else:
            fine = spark.createDataFrame([], "coarse_id int, cell_id bigint, centroid array<double>")
            stored = spark.createDataFrame([], f"coarse_id int, cell_id bigint, id bigint, embedding {kind}, "
                                               "dist double, far double, norm double")
        stored = stored.sortWithinPartitions("coarse_id", "cell_id").write.mode("overwrite")
        (stored.partitionBy("coarse_id") if n_sample else stored).parquet(f"{path}/vectors")
        written = spark.read.schema(VECTORS.format(kind=kind)).parquet(f"{path}/vectors")
        per_cell = written.groupBy("coarse_id", "cell_id").agg(
            F.max("dist").alias("radius"), F.max("norm").alias("norm"), F.count("*").alias("n"), F.max("far").alias("far"))
        fine.select("coarse_id", "cell_id", "centroid").join(per_cell, ["coarse_id", "cell_id"]) \
            .write.mode("overwrite").parquet(f"{path}/cells")
        totals = spark.read.schema(CELLS).parquet(f"{path}/cells").groupBy("coarse_id").agg(
            F.max("far").alias("radius"), F.max("norm").alias("norm"), F.sum("n").alias("n"), F.count("*").alias("cells")).collect()
        spark.createDataFrame([(*r, [float(v) for v in centres[r.coarse_id]]) for r in totals], COARSE) \
            .coalesce(1).write.mode("overwrite").parquet(f"{path}/coarse")
        tree = cls(spark, path, {"dims": dims, "n": n, "n_sample": n_sample, "seed": seed, "kind": kind, "targets": []})
        for k, recall in calibrate:
            tree.calibrate(k, recall)
        tree._save_params()
        return tree

    def _save_params(self) -> None:
        import json

        self.spark.createDataFrame([(json.dumps(self.params),)], "params string").coalesce(1) \
            .write.mode("overwrite").parquet(f"{self.path}/params")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "VectorTree":
        import json

        return cls(spark, path, json.loads(spark.read.schema("params string").parquet(f"{path}/params").first().params))

    # -------------------------------------------------------------- cells of a query

    def _ranked_coarse(self, queries: DataFrame, keep: str, coarse_probe: int | None = None) -> DataFrame:
        """(qid, q, bar, coarse_id, place): a query's best coarse cells, or those whose bound reaches its ``bar``."""
        c = self.coarse
        shared = self.spark.sparkContext.broadcast(
            (np.array([r.centroid for r in c]).reshape(len(c), int(self.params.get("dims", 1))), np.array([r.radius for r in c]),
             np.array([r.norm for r in c]), np.array([r.coarse_id for r in c], np.int32)))

        def run(batches):
            centres, radius, norm, ids = shared.value
            for b in batches:
                if not b.num_rows or not len(ids):
                    continue
                q = matrix_of(b.column(1))
                s = q @ centres.T
                if keep == "best":
                    order = np.argsort(-s, axis=1, kind="stable")[:, :coarse_probe]
                    row = np.repeat(np.arange(len(q)), order.shape[1])
                    place, which = np.tile(np.arange(order.shape[1]), len(q)), order.ravel()
                else:
                    bound = upper_bound(s, q, radius, norm)
                    row, which = np.nonzero(bound >= np.asarray(b.column(2))[:, None])
                    place = np.zeros(len(row), np.int64)
                at = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(at), b.column(1).take(at), b.column(2).take(at), pa.array(ids[which]),
                     pa.array(place.astype(np.int32))], names=["qid", "q", "bar", "coarse_id", "place"])

        return queries.mapInArrow(run, "qid bigint, q array<double>, bar double, coarse_id int, place int")

    def _fine_cells(self, ranked: DataFrame, keep: str, nprobe: int | None, n_qb: int) -> DataFrame:
        """(qid, coarse_id, cell_id, score, place) of the fine cells of each query's coarse cells."""
        own = ranked.withColumn("qb", F.pmod(F.xxhash64("qid"), F.lit(n_qb)).cast("int"))
        cells = self.cells.withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(n_qb - 1))))

        def run(q: pa.Table, c: pa.Table) -> pa.Table:
            names = ["qid", "coarse_id", "cell_id", "score", "place"]
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.float64(), pa.int32()]
            if not q.num_rows or not c.num_rows:
                return pa.table({n: pa.array([], t) for n, t in zip(names, kinds)})
            x, ids = matrix_of(q["q"]), np.asarray(c["cell_id"])
            order = np.argsort(ids)
            c, ids = c.take(pa.array(order)), ids[order]
            s = x @ matrix_of(c["centroid"]).T
            if keep == "best":
                cells = np.broadcast_to(ids, s.shape)
                if nprobe is not None and s.shape[1] > nprobe:
                    s, cells = keep_best(s, cells, nprobe)
                row, cell, score = np.repeat(np.arange(len(x)), s.shape[1]), cells.ravel(), s.ravel()
            else:
                bound = upper_bound(s, x, np.asarray(c["radius"]), np.asarray(c["norm"]))
                row, which = np.nonzero(bound >= np.asarray(q["bar"])[:, None])
                cell, score = ids[which], bound[row, which]
            take = lambda n: q[n].combine_chunks().take(pa.array(row))
            return pa.table([take("qid"), take("coarse_id"), pa.array(cell), pa.array(score), take("place")], names=names)

        return own.groupBy("coarse_id", "qb").cogroup(cells.groupBy("coarse_id", "qb")).applyInArrow(
            run, "qid bigint, coarse_id int, cell_id bigint, score double, place int")

    # -------------------------------------------------------------- search

    def _numbers(self, k: int, recall: float) -> tuple[int, int]:
        fit = [t for t in self.params.get("targets", []) if t["k"] >= k and t["recall"] >= recall]
        if not fit:
            raise ValueError(f"the index was not calibrated for recall {recall} at k = {k}")
        best = min(fit, key=lambda t: (t["nprobe"], t["coarse_probe"]))
        return best["coarse_probe"], best["nprobe"]

    def _probes(self, queries: DataFrame, coarse_probe: int, nprobe: int, n_qb: int) -> DataFrame:
        cells = self._fine_cells(self._ranked_coarse(queries, "best", coarse_probe), "best", nprobe, n_qb)
        rank = F.row_number().over(Window.partitionBy("qid").orderBy(F.desc("score"), "cell_id"))
        return cells.withColumn("rank", rank).filter(F.col("rank") <= nprobe).select("qid", "coarse_id", "cell_id")

    def search(self, queries: DataFrame, k: int, recall: float = 1.0, nprobe: int | None = None,
               coarse_probe: int | None = None) -> DataFrame:
        """Run (qid, pid, rank, score) of queries (qid, embedding): exact, of a calibrated recall, or of ``nprobe`` cells."""
        return self.search_with_reads(queries, k, recall, nprobe, coarse_probe)[0]

    def search_with_reads(self, queries: DataFrame, k: int, recall: float = 1.0, nprobe: int | None = None,
                          coarse_probe: int | None = None) -> tuple[DataFrame, DataFrame]:
        """The run, and (qid, coarse_id, cell_id) of the cells that were read for it."""
        if k <= 0 or (nprobe is not None and nprobe <= 0) or not 0 < recall <= 1:
            raise ValueError("k and nprobe must be positive, recall above 0 and at most 1")
        exact = nprobe is None and recall == 1
        if exact:
            coarse_probe, nprobe = FIRST_CELLS, FIRST_CELLS
        elif nprobe is None:
            coarse_probe, nprobe = self._numbers(k, recall)
        ship_package()
        queries, n_qb = query_rows(queries)
        probes = materialize(self._probes(queries, coarse_probe or max(FIRST_CELLS, nprobe), nprobe, n_qb), "tree-probes")
        read = lambda probes: read_cells(self.vectors, [(r.coarse_id, r.n) for r in self.coarse],
                                         int(self.params["dims"]), queries, probes, k, n_qb)
        if not exact:
            return merged_topk(read(probes), k), probes
        first = materialize(merged_topk(read(probes), k), "tree-first")
        more = self._fine_cells(self._ranked_coarse(barred(queries, first, k), "bound"), "bound", None, n_qb) \
            .select("qid", "coarse_id", "cell_id").join(probes, ["qid", "coarse_id", "cell_id"], "left_anti")
        more = materialize(more, "tree-more")
        return merged_topk(first.select("qid", "pid", "score").unionByName(read(more)), k), probes.unionByName(more)

    # -------------------------------------------------------------- measures

    def calibrate(self, k: int, recall: float) -> dict:
        """Measure the numbers of coarse and fine cells that find ``recall`` of the exact neighbours of a bounded
        number of the index's own vectors, and keep them for searches of up to ``k`` neighbours."""
        n = int(self.params["n"])
        some = sampled(self.vectors.select("id", "embedding"), n, CALIBRATION_ROWS, int(self.params["seed"]) + 2)
        queries = materialize(some.select(F.col("id").alias("qid"), F.col("embedding").cast("array<double>").alias("q"),
                                          F.lit(0.0).alias("bar")), "tree-calibration")
        exact = knn_exact(self.vectors.select("id", "embedding"), queries.select("qid", F.col("q").alias("embedding")), k)
        cells = self._fine_cells(self._ranked_coarse(queries, "best", len(self.coarse)), "best", None, 1)
        by = Window.partitionBy("qid").orderBy(F.desc("score"), "cell_id")
        cells = cells.select("qid", "cell_id", F.row_number().over(by).alias("fine"), "place")
        # a neighbour is found when its fine and its coarse cell are read: neighbours of each pair of places
        counts = exact.join(self.vectors.select(F.col("id").alias("pid"), "cell_id"), "pid") \
            .join(cells, ["qid", "cell_id"]).groupBy("fine", "place").count()
        rows = sorted((r.fine, r.place, r["count"]) for r in counts.collect())      # bounded by queries x k
        total, have, nprobe = sum(r[2] for r in rows), 0, 1
        margin = recall + (1 - recall) / 2               # room for queries unlike the measured ones
        for fine, _, n_found in rows:
            if have >= margin * total:
                break
            have, nprobe = have + n_found, fine
        coarse_probe = 1 + max([p for f, p, _ in rows if f <= nprobe], default=0)
        target = {"k": k, "recall": recall, "nprobe": int(nprobe), "coarse_probe": int(coarse_probe)}
        self.params["targets"] = [*self.params.get("targets", []), target]
        return target

    def stats(self) -> DataFrame:
        """One row: vectors, cells and their occupancy."""
        return self.cells.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_vectors"), F.count("*").alias("cells_used"),
                              F.countDistinct("coarse_id").alias("coarse_used"), F.min("n").alias("min_cell"),
                              F.max("n").alias("max_cell"))


def upper_bound(s: np.ndarray, q: np.ndarray, radius: np.ndarray, norm: np.ndarray) -> np.ndarray:
    """Largest score that a vector of each cell can have, from the centroids' scores."""
    length = np.sqrt((q ** 2).sum(axis=1))[:, None]
    return np.minimum(s + length * radius, length * norm) + SLACK * (1 + length * (norm + radius))
