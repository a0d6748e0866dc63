"""Centroid clustering of integer vectors with n-simplex projection.

A component x becomes the integer floor(64 x). Rounds of assignment to the
nearest centroid and exact integer means follow each other; distances are
squared Euclidean and exact.

Each vector's squared distances to several pivots are computed once and
written with it. With the pivots they span a simplex whose base is the pivots'
own; the vector's corner, the apex, has coordinates that follow from the
cached distances alone. For two apexes the Euclidean distance is a lower bound
of the distance of their vectors, and with the last coordinate of one turned
over it is an upper bound. A round computes the centroids' apexes and drops
each centroid whose lower bound is above the smallest upper bound; exact
integer distances decide among the rest. Rounding of the bounds is allowed
for, so ties are never dropped.

A round is one pass over the written vectors that sends one row of sums for
each task, cluster and component; only sums of clusters reach the driver.

Defined results: vectors that are null, of another length or hold null or
non-finite components are not kept, and neither are those with a component
of magnitude 2^21 or more, whose squared distances need not fit a 64-bit
integer once scaled; repeated rows are vectors of their own; equal hashes
start in the order of their components and a null id last; fewer kept vectors
than centroids give fewer centroids; equal distances go to the smaller
centroid; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import map_arrow
from quarry.session import materialize

DIMS = 64
SCALE = 64
CENTROIDS = 16
ROUNDS = 3
PIVOTS = 12
CANDIDATES = 64          # vectors that pivots are chosen from; they decide the bounds' sharpness, not the result
LIMIT = 1 << 27          # of an integer component
FLAT = 1e-6              # a pivot closer to the others' span, relative to the base, is left out
SLACK = 1e-7             # rounding of squared bounds, relative to the squared distances they come from


def kept_vectors(vectors: DataFrame, dims: int = DIMS, scale: int = SCALE) -> DataFrame:
    """(vec_id, v): usable vectors as integers."""
    e = F.col("embedding").cast("array<double>")
    finite = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) * scale < LIMIT))
    return vectors.filter((F.size(e) == dims) & finite) \
        .select("vec_id", F.transform(e, lambda x: F.floor(x * scale).cast("int")).alias("v"))


def _smallest(kept: DataFrame, seed: int, n: int) -> np.ndarray:
    """The ``n`` vectors with the smallest hashes of ``seed:id``, in order."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = kept.select(key.alias("key"), "v").orderBy(F.asc_nulls_last("key"), "v").limit(n).collect()
    return np.array([r.v for r in rows], np.int64).reshape(len(rows), len(rows[0].v) if rows else 0)


def squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact squared distances of each row of ``x`` to each row of ``y``."""
    return np.stack([((x - c) ** 2).sum(axis=1) for c in y], axis=1) if len(y) else np.zeros((len(x), 0), np.int64)


class Simplex:
    """The pivots' base simplex, and apexes over it."""

    def __init__(self, candidates: np.ndarray, n: int):
        """Up to ``n`` of the candidates: the first, then always the one farthest from the span of those chosen."""
        d = squared(candidates, candidates).astype(np.float64)
        chosen, height = [0], d[0].copy()
        coordinates = np.zeros((len(candidates), 0))
        while len(chosen) < min(n, len(candidates)):
            far = int(height.argmax())
            if height[far] <= FLAT * max(d[0].max(), 1):
                break
            dot = (d[0] + d[0, far] - d[far]) / 2 - coordinates @ coordinates[far]
            coordinates = np.column_stack([coordinates, dot / np.sqrt(height[far])])
            height = np.maximum(d[0] - (coordinates ** 2).sum(axis=1), 0)
            chosen.append(far)
        self.pivots = candidates[chosen]
        base = coordinates[chosen[1:]]                       # lower triangular: corners 1, 2, ... ; corner 0 is the origin
        self.solve = np.linalg.inv(base).T if len(base) else np.zeros((0, 0))
        self.norms = (base ** 2).sum(axis=1)

    def apex(self, to_pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Coordinates in the base and heights above it, from squared distances to the pivots."""
        d = to_pivots.astype(np.float64)
        x = ((d[:, :1] + self.norms - d[:, 1:]) / 2) @ self.solve
        return x, np.sqrt(np.maximum(d[:, 0] - (x ** 2).sum(axis=1), 0))

    def candidates(self, to_pivots: np.ndarray, centroids: np.ndarray) -> np.ndarray:
        """Mask of the centroids that may be nearest to each vector."""
        from_pivots = squared(centroids, self.pivots)
        (x, h), (y, g) = self.apex(to_pivots), self.apex(from_pivots)
        flat = np.maximum((x ** 2).sum(axis=1)[:, None] + (y ** 2).sum(axis=1)[None, :] - 2 * x @ y.T, 0)
        slack = SLACK * (1.0 + to_pivots.max(axis=1)[:, None] + from_pivots.max(axis=1)[None, :])
        low = flat + (h[:, None] - g[None, :]) ** 2 - slack
        high = flat + (h[:, None] + g[None, :]) ** 2 + slack
        return low <= high.min(axis=1, keepdims=True)


def nearest(v: np.ndarray, to_pivots: np.ndarray, centroids: np.ndarray, simplex: Simplex) -> tuple[np.ndarray, np.ndarray]:
    """Nearest centroid of each vector, the smaller on ties, and its exact squared distance."""
    may = simplex.candidates(to_pivots, centroids)
    best, cluster = np.full(len(v), np.iinfo(np.int64).max), np.zeros(len(v), np.int32)
    for c in range(len(centroids)):
        rows = np.flatnonzero(may[:, c])
        d = ((v[rows] - centroids[c]) ** 2).sum(axis=1)
        less = d < best[rows]
        best[rows[less]], cluster[rows[less]] = d[less], c
    return cluster, best


def _matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten(), np.int64).reshape(len(column), -1)


def _with_distances(kept: DataFrame, simplex: Simplex) -> DataFrame:
    """``kept`` with each vector's squared distances to the pivots."""
    pivots = simplex.pivots

    def run(batches):
        for b in batches:
            if b.num_rows:
                d = squared(_matrix(b.column(1)), pivots)
                lists = pa.ListArray.from_arrays(np.arange(0, d.size + 1, len(pivots), dtype=np.int32), pa.array(d.ravel()))
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), lists], names=["vec_id", "v", "d"])

    kind = kept.schema["vec_id"].dataType.simpleString()
    return map_arrow(kept, run, f"vec_id {kind}, v array<int>, d array<bigint>")


def _sums(cached: DataFrame, centroids: np.ndarray, simplex: Simplex) -> dict[int, tuple[int, list[int]]]:
    """Count and component sums of each cluster that has vectors."""
    k, dims = centroids.shape

    def run(batches):
        total = np.zeros((k, dims + 1), np.int64)
        seen = 0
        for b in batches:
            if b.num_rows:
                v = _matrix(b.column(1))
                cluster, _ = nearest(v, _matrix(b.column(2)), centroids, simplex)
                for c in np.unique(cluster):
                    rows = v[cluster == c]
                    total[c] += np.append(rows.sum(axis=0), len(rows))
                seen += b.num_rows
        if seen:
            c, place = np.meshgrid(np.arange(k, dtype=np.int32), np.arange(dims + 1, dtype=np.int32), indexing="ij")
            yield pa.RecordBatch.from_arrays([pa.array(c.ravel()), pa.array(place.ravel()), pa.array(total.ravel())],
                                             names=["cluster", "place", "s"])

    rows = map_arrow(cached, run, "cluster int, place int, s bigint").groupBy("cluster", "place") \
        .agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()       # k * (dims + 1) rows
    sums = np.zeros((k, dims + 1), object)
    for r in rows:
        sums[r.cluster, r.place] = int(r.s)
    return {c: (sums[c, dims], list(sums[c, :dims])) for c in range(k) if sums[c, dims]}


def cluster(vectors: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, dims: int = DIMS, scale: int = SCALE,
            pivots: int = PIVOTS) -> DataFrame:
    """op12: (vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every kept vector."""
    spark = vectors.sparkSession
    kept = kept_vectors(vectors.select("vec_id", "embedding"), dims, scale)
    centroids = _smallest(kept, 1, k)
    kind = kept.schema["vec_id"].dataType.simpleString()
    if not len(centroids):
        return spark.createDataFrame([], f"vec_id {kind}, cluster int, distance bigint, cluster_inertia bigint, "
                                         "inertia bigint, centroid_sha256 string")
    simplex = Simplex(_smallest(kept, 2, CANDIDATES), pivots)
    cached = materialize(_with_distances(kept, simplex), "pivot-distances")
    for _ in range(rounds):
        for c, (n, total) in _sums(cached, centroids, simplex).items():
            centroids[c] = [s // n for s in total]

    def run(batches):
        for b in batches:
            if b.num_rows:
                c, d = nearest(_matrix(b.column(1)), _matrix(b.column(2)), centroids, simplex)
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(c), pa.array(d)],
                                                 names=["vec_id", "cluster", "distance"])

    assigned = materialize(map_arrow(cached, run, f"vec_id {kind}, cluster int, distance bigint"), "assigned")
    sums = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()  # k rows
    digest = lambda c: hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest()
    every = sum(int(r.s) for r in sums)
    report = spark.createDataFrame([(r.cluster, int(r.s), every, digest(r.cluster)) for r in sums],
                                   "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return assigned.join(F.broadcast(report), "cluster") \
        .select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def oracle_sql(k: int = CENTROIDS, rounds: int = ROUNDS) -> str:
    """The same in SQL: one block of common table expressions for each round."""
    steps = [f"""kept AS (
  SELECT row_number() OVER () AS rid, vec_id, [floor(64 * x::DOUBLE)::BIGINT FOR x IN embedding] AS v
  FROM embeddings
  WHERE len(embedding) = 64 AND len([x FOR x IN embedding IF x IS NOT NULL AND isfinite(x)]) = 64),
comps AS (SELECT rid, unnest(v) AS x, generate_subscripts(v, 1) AS dim FROM kept),
starts AS (
  SELECT rid, row_number() OVER (ORDER BY sha256('1:' || vec_id), v) - 1 AS c
  FROM kept QUALIFY c < {k}),
cents0 AS (SELECT c, dim, x FROM starts JOIN comps USING (rid))"""]
    for r in range(rounds + 1):
        steps.append(f"""dist{r} AS MATERIALIZED (
  SELECT rid, c, sum((p.x - q.x) * (p.x - q.x)) AS d
  FROM comps p JOIN cents{r} q USING (dim) GROUP BY rid, c),
near{r} AS MATERIALIZED (SELECT rid, c, d FROM dist{r} QUALIFY row_number() OVER (PARTITION BY rid ORDER BY d, c) = 1)""")
        if r < rounds:
            steps.append(f"""sums{r} AS (
  SELECT c, dim, sum(x)::HUGEINT AS s, count(*)::HUGEINT AS n FROM near{r} JOIN comps USING (rid) GROUP BY c, dim),
cents{r + 1} AS MATERIALIZED (
  SELECT o.c, o.dim, coalesce((s - ((s % n) + n) % n) // n, o.x)::BIGINT AS x
  FROM cents{r} o LEFT JOIN sums{r} USING (c, dim))""")
    return "WITH " + ",\n".join(steps) + f""",
digests AS (SELECT c, sha256(string_agg(x::VARCHAR, ',' ORDER BY dim)) AS centroid_sha256 FROM cents{rounds} GROUP BY c)
SELECT k.vec_id, n.c::INTEGER AS cluster, n.d::BIGINT AS distance,
       (sum(n.d) OVER (PARTITION BY n.c))::BIGINT AS cluster_inertia, (sum(n.d) OVER ())::BIGINT AS inertia,
       g.centroid_sha256
FROM near{rounds} n JOIN kept k USING (rid) JOIN digests g USING (c)
"""
