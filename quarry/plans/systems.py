"""End-to-end retrieval systems and their side-by-side evaluation.

Three systems answer the same judged query sets:

* ``bm25``: keyword index over the passages that have a vector, OR search;
* ``ann``: search of a trained two-level index over the passage vectors, by
  default until its bounds make the run exact;
* ``cascade``: the ``bm25`` run with its first k results re-ranked by cosine.

Three judgment sets play the roles of a development set and two evaluation
campaigns: ``dev`` (containment, binary), ``eval_one`` and ``eval_two``
(graded, pooled from the top of a keyword run and of an exact vector run).
Each set's queries are the queries it judges. The evaluation spec follows
the studied workload: MRR@10, Recall@100, MAP@100 on dev; MRR@10, NDCG@10,
NDCG@100 on the evaluation sets.

Like the studied workload, which writes every run to a file before scoring
it, the system runners write the judgment sets and each run once to the shared
checkpoint folder and evaluate the written copies: every later step reads
them instead of recomputing an index, and the lineage is cut (a lost
executor does not replay the search).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators import filters as FL
from quarry.operators import index as IX
from quarry.operators import knn as KN
from quarry.operators import metrics as M
from quarry.operators import rerank as RR
from quarry.operators import vector_tree as VT
from quarry.plans import judgments as J
from quarry.session import bounded_broadcast, materialize
from quarry.sources import tables as TB

# Fixed evaluation spec of the studied workload: (set, metric, depth).
SPEC = [
    ("dev", "mrr", 10), ("dev", "recall", 100), ("dev", "map", 100),
    ("eval_one", "mrr", 10), ("eval_one", "ndcg", 10), ("eval_one", "ndcg", 100),
    ("eval_two", "mrr", 10), ("eval_two", "ndcg", 10), ("eval_two", "ndcg", 100),
]
SYSTEMS = ["bm25", "ann", "cascade"]
SETS = ["dev", "eval_one", "eval_two"]
DEPTH = 1000     # run depth of every system
TOP = 1000       # results of the keyword run that the cascade re-ranks
POOL = 20        # judgment pool depth


def _union(dfs: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), dfs)


def query_vectors(spark: SparkSession, sf: str) -> DataFrame:
    vecs = TB.vectors(spark, sf)
    return FL.subset_by_ids(vecs, TB.keyword_queries(spark, sf), "id", "qid") \
        .select(F.col("id").alias("qid"), "embedding")


def judgment_sets(spark: SparkSession, sf: str) -> DataFrame:
    """(eval_set, qid, pid, rel) for the three sets."""
    docs, queries = TB.passages(spark, sf), TB.keyword_queries(spark, sf)
    index = IX.TextIndex.build(docs)
    # before the containment test, which takes the queries' document frequencies from it; written once, with few rows
    kw_pool = materialize(index.search(queries, k=POOL), "keyword-pool")
    # written once: every set refers to the containment pairs (five times)
    contain = materialize(J.containment_qrels(docs, queries, index=index), "containment")
    vec_pool = KN.knn_exact(TB.vectors(spark, sf), query_vectors(spark, sf), POOL)
    labels = TB.labels(spark, sf)
    return _union([
        contain.select(F.lit("dev").alias("eval_set"), "qid", "pid", "rel"),
        J.graded_qrels(contain, kw_pool, labels, POOL).select(F.lit("eval_one").alias("eval_set"), "*"),
        J.graded_qrels(contain, vec_pool, labels, POOL).select(F.lit("eval_two").alias("eval_set"), "*"),
    ])


def evaluate(run: DataFrame, qrels: DataFrame, system: str, spec=SPEC) -> DataFrame:
    """(system, eval_set, metric, k, value) for every spec entry.

    One per-query pass covers all depths of the spec; one
    ``groupBy(eval_set, k)`` gives every metric, unpivoted; the spec picks
    its cells, and a cell whose set has no query in the run scores 0.0.
    """
    ks = sorted({k for _, _, k in spec})
    per = M.per_query_metrics_at(run, qrels, ks, ["eval_set"])
    agg = per.groupBy("eval_set", "k").agg(*[F.coalesce(F.avg(c), F.lit(0.0)).alias(m)
                                             for m, c in M.METRIC_COLUMNS.items()])
    long = agg.unpivot(["eval_set", "k"], list(M.METRIC_COLUMNS), "metric", "value")
    cells = run.sparkSession.createDataFrame(spec, "eval_set string, metric string, k bigint")
    return (cells.join(long, ["eval_set", "metric", "k"], "left")
            .select(F.lit(system).alias("system"), "eval_set", "metric", "k",
                    F.coalesce(F.col("value"), F.lit(0.0)).alias("value")))


def subset_passages(spark: SparkSession, sf: str) -> DataFrame:
    """Passages that have a vector (the collection all three systems share).

    Their ids are broadcast if their bytes allow: texts are then filtered where they are read.
    """
    ids = bounded_broadcast(TB.vectors(spark, sf).select("id"))
    return FL.subset_by_ids(TB.passages(spark, sf), ids, "doc_id", "id")


def saved_subset_passages(spark: SparkSession, sf: str) -> DataFrame:
    """Written once: an index build reads its passages several times, and each time the join would run again."""
    return materialize(subset_passages(spark, sf), "subset-passages")


def to_sets(run: DataFrame, qrels: DataFrame) -> DataFrame:
    """A run of the judged queries, once for every set that judges the query."""
    return run.join(qrels.select("eval_set", "qid").distinct(), "qid")


def bm25_run(spark: SparkSession, sf: str, qrels: DataFrame, depth: int = DEPTH) -> DataFrame:
    """The keyword run of every judged query, each searched once."""
    queries = FL.subset_by_ids(TB.keyword_queries(spark, sf), qrels, "qid")
    return IX.TextIndex.build(saved_subset_passages(spark, sf)).search(queries, k=depth)


def bm25_run_sets(spark: SparkSession, sf: str, qrels: DataFrame, depth: int = DEPTH) -> DataFrame:
    """The keyword run of every set's queries, keyed by (eval_set, qid)."""
    return to_sets(bm25_run(spark, sf, qrels, depth), qrels)


def saved_judgment_sets(spark: SparkSession, sf: str) -> DataFrame:
    return materialize(judgment_sets(spark, sf), "judgment-sets")


def saved_bm25_run(spark: SparkSession, sf: str, qrels: DataFrame, depth: int = DEPTH) -> DataFrame:
    return materialize(bm25_run(spark, sf, qrels, depth), "run-bm25")


def evaluate_bm25(spark: SparkSession, sf: str, qrels: DataFrame | None = None,
                  run: DataFrame | None = None) -> DataFrame:
    qrels = qrels if qrels is not None else saved_judgment_sets(spark, sf)
    run = run if run is not None else saved_bm25_run(spark, sf, qrels)
    return evaluate(to_sets(run, qrels), qrels, "bm25")


def ann_run_sets(spark: SparkSession, sf: str, qrels: DataFrame, recall: float = 1.0) -> DataFrame:
    """Search each judged query vector once, then fan the run out to its sets."""
    qv = FL.subset_by_ids(query_vectors(spark, sf), qrels, "qid")
    tree = VT.VectorTree.build(TB.vectors(spark, sf), calibrate=() if recall == 1 else ((DEPTH, recall),))
    return to_sets(tree.search(qv, DEPTH, recall), qrels)


def evaluate_ann(spark: SparkSession, sf: str, qrels: DataFrame | None = None) -> DataFrame:
    qrels = qrels if qrels is not None else saved_judgment_sets(spark, sf)
    run = materialize(ann_run_sets(spark, sf, qrels), "run-ann")
    return evaluate(run, qrels, "ann")


def cascade_run(spark: SparkSession, sf: str, qrels: DataFrame, top: int = TOP,
                base: DataFrame | None = None) -> DataFrame:
    """The first ``top`` results of the keyword run (given, or built to that depth), re-ranked, each query once."""
    if not 100 <= top <= 1000:
        raise ValueError("top must be in 100..1000")
    base = base if base is not None else saved_bm25_run(spark, sf, qrels, depth=top)
    return RR.rerank(base, query_vectors(spark, sf), TB.vectors(spark, sf), top) \
        .select("qid", "pid", "rank", "score")


def cascade_run_sets(spark: SparkSession, sf: str, qrels: DataFrame, top: int = TOP,
                     base: DataFrame | None = None) -> DataFrame:
    """The cascade run of every set's queries, keyed by (eval_set, qid)."""
    return to_sets(cascade_run(spark, sf, qrels, top, base), qrels)


def evaluate_cascade(spark: SparkSession, sf: str, qrels: DataFrame | None = None,
                     base: DataFrame | None = None) -> DataFrame:
    qrels = qrels if qrels is not None else saved_judgment_sets(spark, sf)
    run = materialize(cascade_run(spark, sf, qrels, base=base), "run-cascade")
    return evaluate(to_sets(run, qrels), qrels, "cascade")


def eval_matrix(spark: SparkSession, sf: str, qrels: DataFrame | None = None) -> DataFrame:
    """All three systems on all sets; the keyword run is built once and reused."""
    qrels = qrels if qrels is not None else saved_judgment_sets(spark, sf)
    bm25 = saved_bm25_run(spark, sf, qrels)
    return _union([evaluate_bm25(spark, sf, qrels, bm25), evaluate_ann(spark, sf, qrels),
                   evaluate_cascade(spark, sf, qrels, base=bm25)])


def compare_systems(matrix: DataFrame, systems=SYSTEMS) -> DataFrame:
    """(eval_set, metric, k, <one column per system>)."""
    return matrix.groupBy("eval_set", "metric", "k").pivot("system", list(systems)).agg(F.first("value"))


def row_counts(spark: SparkSession, sf: str) -> DataFrame:
    """(source, n_rows) of every table the systems load or derive."""
    qrels = saved_judgment_sets(spark, sf)
    named = [
        ("documents", TB.passages(spark, sf)),
        ("passages_with_vector", subset_passages(spark, sf)),
        ("queries", TB.keyword_queries(spark, sf)),
        ("vectors", TB.vectors(spark, sf)),
        ("query_vectors", query_vectors(spark, sf)),
    ]
    parts = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(n).alias("source"), "n_rows")
             for n, df in named]
    per_set = qrels.groupBy("eval_set").agg(F.count(F.lit(1)).alias("n_rows"),
                                            F.countDistinct("qid").alias("n_q"))
    parts.append(per_set.select(F.concat(F.lit("qrels_"), F.col("eval_set")).alias("source"), "n_rows"))
    parts.append(per_set.select(F.concat(F.lit("queries_"), F.col("eval_set")).alias("source"),
                                F.col("n_q").alias("n_rows")))
    return _union(parts)
