"""Nearest-neighbour graph by propagation: M neighbours for every vector, without comparing all pairs.

Vectors start with the neighbours they have inside blocks of a random
projection order. A round then looks at neighbours of neighbours: each vector
sends its current list, forward and reverse edges alike, to a group of its own,
where every two members of the list are compared in one matrix product, and
each gets the others' best as candidates. A vector that very many others point
to keeps a bounded number of its reverse edges, a different choice in each
round, so no group grows with the data; its forward edges are all used. After a
bounded number of rounds, or when a round changes few edges, the lists are the
graph.

A group holds at most ``2 * m + 1`` vectors, so a round's work is linear in
rows. Groups stream through a task in order, many in one product; a candidate
leaves a group only where its score reaches the worst of the member's list so
far, and all are merged by one shuffle. Every round is written down.

Similarity is the inner product; ties go to the smaller id. Null vectors are
left out; ids must be unique; a table of at most m + 1 vectors gives all
others; an empty table gives an empty graph.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.operators.knn import keep_best, matrix_of
from quarry.session import map_bounded, materialize, ship_package

BLOCK_ROWS = 256          # vectors of a starting block, about
STARTS = 4                # random projections that starting blocks are cut along
ROUNDS = 8
SETTLED = 0.002           # share of edges that a last round may still change
LIST_CELLS = 1 << 20      # pairs of list members in one product
EDGES = "id bigint, other bigint, score double"


def _best_pairs(ids: np.ndarray, x: np.ndarray, m: int) -> pa.Table:
    """The best ``m`` others of each row, as edges."""
    n = len(ids)
    if n < 2:
        return pa.table({"id": pa.array([], pa.int64()), "other": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
    s = x @ x.T
    np.fill_diagonal(s, -np.inf)
    others = np.broadcast_to(ids, s.shape)
    if n > m:
        s, others = keep_best(s, others, m)
    s, others = s.ravel(), others.ravel()
    some = np.flatnonzero(s > -np.inf)
    return pa.table({"id": pa.array(np.repeat(ids, len(s) // n)[some]), "other": pa.array(others[some]), "score": pa.array(s[some])})


def _merged(edges: DataFrame, m: int) -> DataFrame:
    """The best ``m`` distinct edges of each vector, and whether each is ``new``: one shuffle, by vector."""
    best = Window.partitionBy("id").orderBy(F.desc("score"), "other")
    return edges.repartition("id").groupBy("id", "other").agg(F.max("score").alias("score"), F.min("new").alias("new")) \
        .withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= m).select("id", "other", "score", "new")


def _start(vectors: DataFrame, m: int, n: int, seed: int) -> DataFrame:
    """Edges inside blocks of the vectors' order along random projections."""
    dims = F.size("embedding")
    parts = None
    for k in range(STARTS):
        # pseudo-random directions that every executor derives alike
        weight = lambda i: F.sin((i + 1).cast("double") * (12.9898 + 7.31 * k + seed))  # noqa: B023, E731
        along = F.aggregate(F.zip_with("embedding", F.transform(F.sequence(F.lit(0), dims - 1), weight),
                                       lambda a, b: a.cast("double") * b), F.lit(0.0), lambda s, v: s + v)
        blocks = max(1, math.ceil(n / BLOCK_ROWS))
        ordered = vectors.withColumn("along", along).repartitionByRange(blocks, "along", "id") \
            .select(F.spark_partition_id().alias("block"), "id", "embedding")

        def run(table: pa.Table) -> pa.Table:
            return _best_pairs(np.asarray(table["id"], np.int64), matrix_of(table["embedding"]), m)

        # a block of equal projections is cut by the id's hash, so none is larger than a few times the bound
        size = Window.partitionBy("block")
        cut = ordered.withColumn("rows", F.count(F.lit(1)).over(size)) \
            .withColumn("part", F.pmod(F.xxhash64("id"), F.ceil(F.col("rows") / (4 * BLOCK_ROWS))))
        found = cut.groupBy("block", "part").applyInArrow(run, EDGES)
        parts = found if parts is None else parts.unionByName(found)
    return _merged(parts.withColumn("new", F.lit(True)), m)


def _round(vectors: DataFrame, edges: DataFrame, m: int, round_: int) -> DataFrame:
    """Candidate edges between the members of each vector's list and the vector itself, that are among a member's best."""
    forward = edges.select(F.col("id").alias("at"), F.col("other").alias("member"))
    pick = Window.partitionBy("at").orderBy(F.xxhash64("member", F.lit(round_)), "member")
    reverse = edges.select(F.col("other").alias("at"), F.col("id").alias("member")) \
        .withColumn("n", F.row_number().over(pick)).filter(F.col("n") <= m).drop("n")
    lists = forward.unionByName(reverse).unionByName(vectors.select(F.col("id").alias("at"), F.col("id").alias("member"))) \
        .distinct()
    # the worst score of a full list: what is below it can't enter
    bars = edges.groupBy(F.col("id").alias("member")).agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("bar")) \
        .filter(F.col("n") >= m).drop("n")
    members = vectors.select(F.col("id").alias("member"), "embedding").join(bars, "member", "left")
    placed = lists.join(members, "member").select("at", "member", "bar", "embedding")
    return map_bounded(placed.repartition("at").sortWithinPartitions("at"), _compare_lists, EDGES)


def _compare_lists(batches):
    """Edges from rows (at, member, bar, embedding) in order of lists; a batch's last list waits for the next batch."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        if held is not None:
            batch = pa.Table.from_batches([held, batch.cast(held.schema)]).combine_chunks().to_batches()[0]
        at = batch.column(0).to_numpy(zero_copy_only=False)
        last = int(np.flatnonzero(np.diff(at, prepend=at[0]))[-1]) if at[-1] != at[0] else 0
        if last:
            yield from _better_pairs(batch.slice(0, last))
        held = batch.slice(last)
    if held is not None:
        yield from _better_pairs(held)


def _better_pairs(whole: pa.RecordBatch):
    """Pairs of members of a list that reach the first one's bar, lists of about a size in one product."""
    at, ids = (whole.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
    bar = whole.column(2).fill_null(-np.inf).to_numpy(zero_copy_only=False)
    x = matrix_of(whole.column(3))
    begin = np.flatnonzero(np.diff(at, prepend=at[0] - 1))
    size = np.diff(begin, append=len(at))
    by_size = np.argsort(size, kind="stable")
    lo = 0
    while lo < len(by_size):
        # lists in order of size: as many as a product's bounded cells hold
        cells = np.arange(1, len(by_size) - lo + 1) * size[by_size[lo:]] ** 2
        hi = lo + max(1, int(np.searchsorted(cells, LIST_CELLS, "right")))
        some = by_size[lo:hi]
        width = np.arange(size[some[-1]])
        there = width < size[some][:, None]
        row = np.where(there, begin[some][:, None] + width, 0)
        s = np.matmul(x[row], x[row].transpose(0, 2, 1))
        able = there[:, :, None] & there[:, None, :] & (s >= bar[row][:, :, None]) & (s > -np.inf)
        able[:, width, width] = False
        group, one, other = np.nonzero(able)
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids[row[group, one]]), pa.array(ids[row[group, other]]), pa.array(s[group, one, other])],
            names=["id", "other", "score"])
        lo = hi


def neighbor_graph(vectors: DataFrame, m: int = 16, rounds: int = ROUNDS, seed: int = 7) -> DataFrame:
    """(id, other, rank, score): ``m`` near neighbours of each of ``vectors(id, embedding)``, itself not among them."""
    if m <= 0 or rounds < 0:
        raise ValueError("m must be positive, rounds not negative")
    ship_package()
    vectors = materialize(vectors.select(F.col("id").cast("bigint").alias("id"), "embedding").filter("embedding is not null"),
                          "graph-vectors")
    n = vectors.count()
    edges = materialize(_start(vectors, m, n, seed), "graph-start") if n else \
        vectors.sparkSession.createDataFrame([], EDGES)
    for r in range(rounds if n > m + 1 else 0):
        found = _round(vectors, edges, m, r).withColumn("new", F.lit(True))
        edges = materialize(_merged(edges.withColumn("new", F.lit(False)).unionByName(found), m), "graph-round")
        if edges.filter("new").count() <= SETTLED * n * m:
            break
    rank = F.row_number().over(Window.partitionBy("id").orderBy(F.desc("score"), "other"))
    return edges.withColumn("rank", rank.cast("bigint")).select("id", "other", "rank", "score")


def graph_recall(vectors: DataFrame, graph: DataFrame, m: int) -> DataFrame:
    """One row (n_vectors, recall): share of the exact ``m`` nearest others that the graph holds, by exhaustive search."""
    from quarry.operators.knn import knn_exact

    queries = vectors.select(F.col("id").alias("qid"), "embedding")
    exact = knn_exact(vectors, queries, m + 1).filter("qid <> pid")
    best = Window.partitionBy("qid").orderBy("rank")
    exact = exact.withColumn("at", F.row_number().over(best)).filter(F.col("at") <= m).select(
        F.col("qid").alias("id"), F.col("pid").alias("other"))
    found = exact.join(graph.select("id", "other", F.lit(1).alias("found")), ["id", "other"], "left")
    return found.agg(F.countDistinct("id").alias("n_vectors"), F.avg(F.coalesce("found", F.lit(0))).alias("recall"))
