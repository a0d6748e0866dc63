"""Cascade re-ranking: reorder the first k results of a run by embedding cosine.

Only the first k ranks of every query are looked at (the rest is dropped).
Both vector lookups are equi-joins on the id; the query vectors join on
``qid`` (one row per query) and the passage vectors on ``pid``. The new
order is cosine descending, ties keeping the original rank order. A run
passage without a vector raises ``ValueError`` (``on_missing='error'``,
checked over the id columns before the re-ranking job) or is dropped
(``'drop'``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.vector import cosine
from quarry.operators.metrics import truncate_run
from quarry.operators.search import topk
from quarry.operators.vector_table import VectorTable
from quarry.session import BROADCAST_BYTES, bounded_broadcast, materialize


def missing_vectors(run: DataFrame, vectors: DataFrame) -> DataFrame:
    """Run rows whose passage has no vector (a left anti join)."""
    return run.join(vectors.select(F.col("id").alias("pid")), "pid", "left_anti")


def _missing_pids(head: DataFrame, p_vectors: DataFrame) -> DataFrame:
    """Head passage ids without a vector; reads only the id column of the vectors."""
    wanted = head.select("pid").distinct()
    found = p_vectors.select(F.col("id").alias("pid")).join(wanted, "pid", "left_semi")
    return wanted.join(found, "pid", "left_anti")


def rerank(run: DataFrame, q_vectors: DataFrame, p_vectors: DataFrame | VectorTable, k: int,
           on_missing: str = "error", broadcast_bytes: int | None = BROADCAST_BYTES) -> DataFrame:
    """Run (qid, pid, rank, score, orig_rank): the first k of ``run`` by cosine.

    ``q_vectors(qid, embedding)``, ``p_vectors(id, embedding)``; a ``VectorTable``
    of passage vectors is read only where its directories hold ids of the head.

    When the counted bytes of the run head (queries x k rows) are within
    ``broadcast_bytes``, the head is broadcast and the passage-vector table is
    streamed past it, never shuffled; beyond the bound the planner's shuffle
    join applies. ``on_missing='error'`` first checks that every head passage
    (and query) has a vector -- a query over the id columns only -- and
    raises ``ValueError`` naming one that does not.
    """
    if on_missing not in ("error", "drop"):
        raise ValueError(f"on_missing must be 'error' or 'drop', got {on_missing!r}")
    # the head (queries x k rows) is written once: counting it, checking it
    # and joining it then read the copy instead of re-running the search
    head = materialize(truncate_run(run, k).select("qid", "pid", F.col("rank").alias("orig_rank")),
                       "rerank-head")
    placed = isinstance(p_vectors, VectorTable)
    if on_missing == "error":
        if placed:
            wanted = head.select("pid").distinct()
            gone = wanted.join(p_vectors.lookup(wanted, broadcast_bytes=broadcast_bytes).select("pid"), "pid",
                               "left_anti").limit(1).collect()
        else:
            gone = _missing_pids(head, p_vectors).limit(1).collect()
        if gone:
            raise ValueError(f"no vector for passage {gone[0]['pid']}")
        gone_q = (head.select("qid").distinct()
                  .join(q_vectors.select("qid"), "qid", "left_anti").limit(1).collect())
        if gone_q:
            raise ValueError(f"no vector for query {gone_q[0]['qid']}")
    qv = q_vectors.select("qid", F.col("embedding").alias("qv"))
    if placed:
        j = p_vectors.lookup(head, out="pv", broadcast_bytes=broadcast_bytes).join(qv, "qid")
    else:
        pv = p_vectors.select(F.col("id").alias("pid"), F.col("embedding").alias("pv"))
        j = pv.join(bounded_broadcast(head, broadcast_bytes), "pid").join(qv, "qid")
    scored = j.select("qid", "pid", "orig_rank", cosine("qv", "pv").alias("score"))
    return topk(scored, None, "qid", [F.col("score").desc(), F.col("orig_rank").asc()]) \
        .select("qid", "pid", "rank", "score", "orig_rank")
