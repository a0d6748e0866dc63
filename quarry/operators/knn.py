"""Exact k-nearest-neighbour search by inner product, as blocked matrix products.

Small query sets (the usual batch) take a broadcast path: the query block,
bounded by ``q_block_rows``, is one broadcast variable and each passage
partition streams through a running top-k -- passages are not shuffled.

For larger query sets the pair space queries x passages is cut into a grid
of cells: passages are hashed into ``n_pb`` blocks and queries into ``n_qb``
blocks, each passage row is replicated to every query block and each query
row to every passage block (the replication scheme of distributed block
matrix multiplication), and one ``cogroup`` task per cell multiplies its two
blocks with NumPy and keeps the k best passages per query. Block counts
follow the table sizes, so a cell holds about ``p_block_rows`` passages and
as many queries at most whatever the scale (``q_block_rows`` where that makes
no more cells than the cores can use), and nothing goes through the driver.

Either way no pair is ever a row. Every task leaves at most k rows per query;
these are merged in two steps (groups of ``MERGE`` tasks first, then all), so
the last task of a query reads k rows from each group, not from each split.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.operators.search import topk
from quarry.session import ship_package

PAIR_SCHEMA = "qid BIGINT, pid BIGINT, score DOUBLE"
MERGE = 256       # partial results of a query merged by one task in the first step
SUB_BATCH = 2048  # passages per matrix product inside a cell (bounds the score matrix)
FIRST_BATCH = 256  # passages of the first product
QUERY_ROWS = 1024  # queries per matrix product inside a cell
HITS = 1 << 16    # pairs scored in double precision at a time
DENSE = 64        # share of a product's pairs (one in so many) beyond which its own k-th best scores are looked for
CELLS = 4         # cells of the grid for each core, at least, where the queries have as many blocks
ROUNDING = 2.0 ** -23     # of single precision: twice the error of one rounding
SINGLE_NORM = 1e10        # longest vector that is multiplied in single precision


def matrix_of(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Rows of a list column of equal lengths as one matrix of doubles, straight from its Arrow buffer."""
    whole = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if not len(whole):
        return np.zeros((0, 0))
    return whole.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False).reshape(len(whole), -1)


def pairs_table(qid, pid, score) -> pa.Table:
    return pa.table({"qid": pa.array(qid, pa.int64()), "pid": pa.array(pid, pa.int64()), "score": pa.array(score, pa.float64())})


def keep_best(s: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Per row, the k entries of largest score, ties to the smaller id.

    ``argpartition`` picks k best in linear time; only a row whose k-th
    score is tied with an entry left out is re-selected exactly.
    """
    part = np.argpartition(-s, k - 1, axis=1)[:, :k]
    sel_s = np.take_along_axis(s, part, axis=1)
    sel_i = np.take_along_axis(ids, part, axis=1)
    kth = sel_s.min(axis=1, keepdims=True)
    tied = (s == kth).sum(axis=1) > (sel_s == kth).sum(axis=1)
    for r in np.nonzero(tied)[0]:
        order = np.lexsort((ids[r], -s[r]))[:k]
        sel_s[r], sel_i[r] = s[r, order], ids[r, order]
    return sel_s, sel_i


class RunningTopK:
    """Best k passages per query over a stream of passage batches.

    Order: score descending, then passage id ascending (ties to the smaller id).

    A product in single precision finds the pairs that can reach a query's k-th
    best score so far, less the most that its rounding can amount to; only
    these few are scored, in double precision and all by one formula, so equal
    vectors tie. Vectors too large for that, or not finite, are multiplied in
    double precision.
    """

    def __init__(self, q_ids: np.ndarray, q: np.ndarray, k: int):
        self.q_ids, self.q, self.k = q_ids, q, k
        self.best_s = np.full((len(q_ids), k), -np.inf)
        self.best_p = np.full((len(q_ids), k), np.iinfo(np.int64).max)
        self.seen = 0
        self.norm = _norms(q)
        self.single = bool((self.norm <= SINGLE_NORM).all())
        self.q_single = q.astype(np.float32) if self.single else q

    def add(self, p_ids: np.ndarray, p: np.ndarray, reads: tuple[np.ndarray, np.ndarray] | None = None) -> None:
        """Offer passages; ``reads`` = (mask of the cells each query reads, cell of each passage) leaves some out."""
        norm = _norms(p)
        single = self.single and bool((norm <= SINGLE_NORM).all())
        at = 0
        while at < len(p_ids) and len(self.q_ids):
            # few passages at first: a bar that is reached soon spares most of the work
            to = at + min(SUB_BATCH, max(FIRST_BATCH, self.k, self.seen))
            some = p[at:to]
            s = self.q_single @ some.T.astype(np.float32) if single else self.q @ some.T
            if not single:
                s[np.isnan(s)] = -np.inf
            if reads is not None:
                s[~reads[0][:, reads[1][at:to]]] = -np.inf
            slack = (p.shape[1] + 4) * ROUNDING * self.norm * norm[at:to].max() + 1e-30 if single else np.zeros(len(s))
            self._offer(s, p_ids[at:to], some, slack, single)
            self.seen += len(some)
            at = to

    def _offer(self, s: np.ndarray, ids: np.ndarray, p: np.ndarray, slack: np.ndarray, single: bool) -> None:
        bar = self.best_s.min(axis=1)
        hits = s >= _below(bar - slack, s.dtype)[:, None]
        if np.count_nonzero(hits) > s.size // DENSE and s.shape[1] > self.k:     # the block's own k-th best scores are higher bars
            kth = np.partition(s, s.shape[1] - self.k, axis=1)[:, s.shape[1] - self.k].astype(np.float64)
            hits = s >= _below(np.maximum(bar - slack, kth - 2 * slack), s.dtype)[:, None]
        row, col = np.divmod(np.flatnonzero(hits), s.shape[1])
        lo = 0
        while lo < len(row):
            # whole queries
            hi = int(np.searchsorted(row, row[min(lo + HITS, len(row)) - 1], "left" if lo + HITS < len(row) else "right"))
            hi = hi if hi > lo else int(np.searchsorted(row, row[lo], "right"))
            r, c = row[lo:hi], col[lo:hi]
            self._merge(r, np.einsum("ij,ij->i", self.q[r], p[c]) if single else s[r, c], ids[c])
            lo = hi

    def _merge(self, row: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        """Put candidates, by query, among the best so far."""
        some = np.unique(row)
        row = np.concatenate([np.repeat(some, self.k), row])
        score = np.concatenate([self.best_s[some].ravel(), score])
        ids = np.concatenate([self.best_p[some].ravel(), ids])
        order = np.lexsort((ids, -score, row))
        size = np.bincount(np.searchsorted(some, row))
        place = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
        order = order[place < self.k]
        self.best_s[some] = score[order].reshape(-1, self.k)
        self.best_p[some] = ids[order].reshape(-1, self.k)

    def table(self) -> pa.Table:
        score = self.best_s.ravel()
        some = np.flatnonzero(score > -np.inf)
        return pairs_table(np.repeat(self.q_ids, self.k)[some], self.best_p.ravel()[some], score[some])


def _norms(x: np.ndarray) -> np.ndarray:
    return np.sqrt(np.einsum("ij,ij->i", x, x))


def _below(bar: np.ndarray, kind: np.dtype) -> np.ndarray:
    """The bars in a precision, none rounded up, and above -inf."""
    bar = bar.astype(kind) if kind == np.float64 else np.nextafter(bar.astype(kind), np.float32(-np.inf))
    return np.maximum(bar, np.finfo(kind).min)


def pair_kernel(k: int):
    """Best k passages (id, embedding) of each query (qid, query) of a pair of blocks; ties to the smaller passage id."""
    def run(p: pa.Table, q: pa.Table) -> pa.Table:
        if not p.num_rows or not q.num_rows:     # a side without rows may come without columns
            return pairs_table([], [], [])
        p_ids, p_x = np.asarray(p["id"], np.int64), matrix_of(p["embedding"])
        q_ids, q_x = np.asarray(q["qid"], np.int64), matrix_of(q["query"])
        parts = []
        for at in range(0, len(q_ids), QUERY_ROWS):
            best = RunningTopK(q_ids[at:at + QUERY_ROWS], q_x[at:at + QUERY_ROWS], k)
            best.add(p_ids, p_x)
            parts.append(best.table())
        return pa.concat_tables(parts)
    return run


def _stream_kernel(bc, k: int):
    def run(batches):
        q_ids, q = bc.value
        best = RunningTopK(q_ids, q, k)
        for b in batches:
            if b.num_rows:
                best.add(np.asarray(b.column(0), np.int64), matrix_of(b.column(1)))
        if len(q_ids):
            yield from best.table().to_batches()
    return run


def merged_topk(pairs: DataFrame, k: int) -> DataFrame:
    """Run (qid, pid, rank, score) from the partial results of many tasks, merged in two steps."""
    order = [F.col("score").desc(), F.col("pid").asc()]
    tasks = pairs.withColumn("part", F.floor(F.spark_partition_id() / MERGE))
    first = Window.partitionBy("qid", "part").orderBy(*order)
    some = tasks.withColumn("rn", F.row_number().over(first)).where(F.col("rn") <= k).drop("part", "rn")
    return topk(some, k, "qid", order).select("qid", "pid", "rank", "score")


def _grid(n_p: int, n_q: int, p_block_rows: int, q_block_rows: int, cores: int) -> tuple[int, int]:
    """Blocks of passages and of queries: a passage is copied once for each block of queries, so these are few.

    As many as the memory of a cell asks for, and more only where the cores would wait.
    """
    n_pb = max(1, math.ceil(n_p / p_block_rows))
    most = math.ceil(n_q / q_block_rows)
    return n_pb, max(1, min(most, max(math.ceil(n_q / p_block_rows), math.ceil(CELLS * cores / n_pb))))


def knn_exact(passages: DataFrame, queries: DataFrame, k: int,
              p_block_rows: int = 65536, q_block_rows: int = 4096,
              n_passages: int | None = None, n_queries: int | None = None) -> DataFrame:
    """Run (qid, pid, rank, score): the k passages of largest inner product per query.

    ``passages(id, embedding)``, ``queries(qid, embedding)``. Fewer than k
    passages give fewer rows (never padding). Ties go to the smaller id.

    If the queries fit in one block (at most ``q_block_rows``, a size bound
    checked by a count), they travel as one broadcast variable and every
    passage partition streams its Arrow batches through a running top-k:
    passages are never shuffled. Larger query sets use the cogroup grid.
    The counts may be passed when known.
    """
    if k <= 0 or p_block_rows <= 0 or q_block_rows <= 0:
        raise ValueError("k and the block sizes must be positive")
    ship_package()
    rows = []
    if n_queries is None or n_queries <= q_block_rows:
        rows = queries.select("qid", "embedding").limit(q_block_rows + 1).collect()   # whatever n_queries says
    if rows or n_queries is None:
        n_q = len(rows) if len(rows) <= q_block_rows else queries.count()
    else:
        n_q = n_queries
    if n_q <= q_block_rows:
        q_ids = np.array([r["qid"] for r in rows], dtype=np.int64)
        q = (np.stack([np.asarray(r["embedding"], dtype=np.float64) for r in rows])
             if rows else np.zeros((0, 0)))
        bc = passages.sparkSession.sparkContext.broadcast((q_ids, q))
        pairs = passages.select("id", "embedding").mapInArrow(_stream_kernel(bc, k), PAIR_SCHEMA)
        return merged_topk(pairs, k)
    n_p = n_passages if n_passages is not None else passages.count()
    n_pb, n_qb = _grid(n_p, n_q, p_block_rows, q_block_rows, passages.sparkSession.sparkContext.defaultParallelism)
    p = passages.select("id", "embedding",
                        F.pmod(F.xxhash64("id"), F.lit(n_pb)).alias("pb"),
                        F.explode(F.sequence(F.lit(0), F.lit(n_qb - 1))).alias("qb"))
    # a name of its own: passages and queries may come from one table
    q = queries.select("qid", F.col("embedding").alias("query"),
                       F.pmod(F.xxhash64("qid"), F.lit(n_qb)).alias("qb"),
                       F.explode(F.sequence(F.lit(0), F.lit(n_pb - 1))).alias("pb"))
    p = p.withColumn("qb", F.col("qb").cast("bigint"))
    q = q.withColumn("pb", F.col("pb").cast("bigint"))
    pairs = (p.groupBy("pb", "qb").cogroup(q.groupBy("pb", "qb"))
             .applyInArrow(pair_kernel(k), PAIR_SCHEMA))
    return merged_topk(pairs, k)
