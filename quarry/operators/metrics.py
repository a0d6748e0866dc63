"""Ranking-quality metrics over a run ``(qid, pid, rank)`` and judgments ``(qid, pid, rel)``.

Semantics (per query of the run, run truncated at depth k):

* relevant means ``rel > 0``; a judged-but-0 or unjudged passage is not relevant;
* MRR: 1/rank of the first relevant passage, averaged over the queries that
  have one (misses are left out, not counted as 0);
* Recall and AP: averaged over run queries with at least one relevant
  judgment; denominators count all of that query's relevant judgments;
* NDCG: gain 2^rel - 1, discount log2(rank + 1); the ideal ordering is the
  retrieved list re-sorted by grade; an all-zero ideal scores 0.0 and is
  still counted;
* an empty input gives 0.0 for every metric.

One join and one ``groupBy(qid)``: the per-query windows (running hit count,
ideal position) see at most k rows per query, so no group is unbounded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

METRICS = ("mrr", "recall", "map", "ndcg")


def truncate_run(run: DataFrame, k: int | None) -> DataFrame:
    """Keep the first k ranks of every query (rank is the 1-based position)."""
    return run if k is None else run.where(F.col("rank") <= F.lit(k))


def relevant(qrels: DataFrame) -> DataFrame:
    return qrels.where(F.col("rel") > 0)


def judged_run(run: DataFrame, qrels: DataFrame, k: int | None,
               keys: list[str] | None = None) -> DataFrame:
    """(keys..., qid, pid, rank, rel): the run's first k rows with grades (missing = 0)."""
    keys = list(keys or [])
    qkeys = [c for c in keys if c in qrels.columns]
    r = truncate_run(run, k).select(*keys, "qid", "pid", "rank")
    q = qrels.select(*qkeys, "qid", "pid", "rel")
    return (r.join(q, [*qkeys, "qid", "pid"], "left")
            .withColumn("rel", F.coalesce(F.col("rel"), F.lit(0))))


def precision_at_hits(run: DataFrame, qrels: DataFrame, k: int | None,
                      keys: list[str] | None = None) -> DataFrame:
    """(keys..., qid, rank, pid, precision) at every relevant position of the run."""
    keys = list(keys or [])
    j = judged_run(run, qrels, k, keys).withColumn("hit", (F.col("rel") > 0).cast("int"))
    w = Window.partitionBy(*keys, "qid").orderBy("rank").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    return (j.withColumn("hits", F.sum("hit").over(w))
            .where(F.col("hit") == 1)
            .select(*keys, "qid", "rank", "pid",
                    (F.col("hits") / F.col("rank")).alias("precision")))


def per_query_metrics(run: DataFrame, qrels: DataFrame, k: int | None,
                      keys: list[str] | None = None) -> DataFrame:
    """(keys..., qid, n_rel, n_hits, rr, recall, ap, ndcg): one row per run query.

    rr is NULL without a hit; recall and ap are NULL when the query has no
    relevant judgment; ndcg is never NULL.
    """
    keys = list(keys or [])
    qkeys = [c for c in keys if c in qrels.columns]
    part = [*keys, "qid"]
    j = judged_run(run, qrels, k, keys).withColumn("hit", (F.col("rel") > 0).cast("int"))
    by_rank = Window.partitionBy(*part).orderBy("rank").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    ideal = Window.partitionBy(*part).orderBy(F.col("rel").desc(), F.col("rank"))
    gain = F.pow(F.lit(2.0), F.col("rel").cast("double")) - F.lit(1.0)
    j = (j.withColumn("hits", F.sum("hit").over(by_rank))
         .withColumn("ideal_pos", F.row_number().over(ideal)))
    per = j.groupBy(*part).agg(
        F.min(F.when(F.col("hit") == 1, F.col("rank"))).alias("first_hit"),
        F.sum("hit").cast("bigint").alias("n_hits"),
        F.sum(F.when(F.col("hit") == 1, F.col("hits") / F.col("rank"))).alias("sum_prec"),
        F.sum(gain / F.log2(F.col("rank") + F.lit(1))).alias("dcg"),
        F.sum(gain / F.log2(F.col("ideal_pos") + F.lit(1))).alias("idcg"))
    n_rel = (relevant(qrels).groupBy(*qkeys, "qid")
             .agg(F.count(F.lit(1)).cast("bigint").alias("n_rel")))
    per = per.join(n_rel, [*qkeys, "qid"], "left")
    has_rel = F.col("n_rel").isNotNull()
    return per.select(
        *part, "n_rel", "n_hits",
        (F.lit(1.0) / F.col("first_hit")).alias("rr"),
        F.when(has_rel, F.col("n_hits") / F.col("n_rel")).alias("recall"),
        F.when(has_rel, F.coalesce(F.col("sum_prec"), F.lit(0.0)) / F.col("n_rel")).alias("ap"),
        F.when(F.col("idcg") > 0, F.col("dcg") / F.col("idcg")).otherwise(F.lit(0.0)).alias("ndcg"))


def per_query_metrics_at(run: DataFrame, qrels: DataFrame, ks: list[int],
                         keys: list[str] | None = None) -> DataFrame:
    """(keys..., qid, k, n_rel, n_hits, rr, recall, ap, ndcg) for several depths in one pass.

    Same values as ``per_query_metrics`` at each k. The running hit count
    does not depend on k; the ideal order of the top k does, so there is one
    window per depth, partitioned by (qid, rank <= k) -- a sort, no extra
    shuffle. Every metric is then a conditional sum over rank <= k.
    """
    keys = list(keys or [])
    qkeys = [c for c in keys if c in qrels.columns]
    part = [*keys, "qid"]
    ks = sorted(set(ks))
    j = judged_run(run, qrels, max(ks), keys).withColumn("hit", (F.col("rel") > 0).cast("int"))
    by_rank = Window.partitionBy(*part).orderBy("rank").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    j = j.withColumn("hits", F.sum("hit").over(by_rank))
    gain = F.pow(F.lit(2.0), F.col("rel").cast("double")) - F.lit(1.0)
    aggs = []
    for k in ks:
        top = F.col("rank") <= F.lit(k)
        ideal = Window.partitionBy(*part, top).orderBy(F.col("rel").desc(), F.col("rank"))
        j = j.withColumn(f"ideal_{k}", F.row_number().over(ideal))
        hit = top & (F.col("hit") == 1)
        aggs += [
            F.min(F.when(hit, F.col("rank"))).alias(f"first_{k}"),
            F.sum(F.when(top, F.col("hit")).otherwise(0)).cast("bigint").alias(f"nh_{k}"),
            F.sum(F.when(hit, F.col("hits") / F.col("rank"))).alias(f"sp_{k}"),
            F.sum(F.when(top, gain / F.log2(F.col("rank") + F.lit(1)))).alias(f"dcg_{k}"),
            F.sum(F.when(top, gain / F.log2(F.col(f"ideal_{k}") + F.lit(1)))).alias(f"idcg_{k}"),
        ]
    per = j.groupBy(*part).agg(*aggs)
    per = per.select(*part, F.explode(F.array(*[F.struct(
        F.lit(k).cast("bigint").alias("k"), F.col(f"first_{k}").alias("first_hit"),
        F.col(f"nh_{k}").alias("n_hits"), F.col(f"sp_{k}").alias("sum_prec"),
        F.col(f"dcg_{k}").alias("dcg"), F.col(f"idcg_{k}").alias("idcg")) for k in ks])).alias("m"))
    per = per.select(*part, "m.*")
    n_rel = (relevant(qrels).groupBy(*qkeys, "qid")
             .agg(F.count(F.lit(1)).cast("bigint").alias("n_rel")))
    per = per.join(n_rel, [*qkeys, "qid"], "left")
    has_rel = F.col("n_rel").isNotNull()
    return per.select(
        *part, "k", "n_rel", "n_hits",
        (F.lit(1.0) / F.col("first_hit")).alias("rr"),
        F.when(has_rel, F.col("n_hits") / F.col("n_rel")).alias("recall"),
        F.when(has_rel, F.coalesce(F.col("sum_prec"), F.lit(0.0)) / F.col("n_rel")).alias("ap"),
        F.when(F.col("idcg") > 0, F.col("dcg") / F.col("idcg")).otherwise(F.lit(0.0)).alias("ndcg"))


METRIC_COLUMNS = {"mrr": "rr", "recall": "recall", "map": "ap", "ndcg": "ndcg"}


def aggregate_metric(per_query: DataFrame, metric: str, k: int | None,
                     keys: list[str] | None = None) -> DataFrame:
    """(keys..., metric, k, value): mean over the queries the metric counts."""
    keys = list(keys or [])
    value = F.coalesce(F.avg(METRIC_COLUMNS[metric]), F.lit(0.0)).alias("value")
    head = [F.lit(metric).alias("metric"), F.lit(k).cast("bigint").alias("k")]
    if keys:
        return per_query.groupBy(*keys).agg(value).select(*keys, *head, "value")
    return per_query.agg(value).select(*head, "value")


def mrr(run, qrels, k, keys=None):
    return aggregate_metric(per_query_metrics(run, qrels, k, keys), "mrr", k, keys)


def recall(run, qrels, k, keys=None):
    return aggregate_metric(per_query_metrics(run, qrels, k, keys), "recall", k, keys)


def mean_ap(run, qrels, k, keys=None):
    return aggregate_metric(per_query_metrics(run, qrels, k, keys), "map", k, keys)


def ndcg(run, qrels, k, keys=None):
    return aggregate_metric(per_query_metrics(run, qrels, k, keys), "ndcg", k, keys)


def run_lists(run: DataFrame) -> DataFrame:
    """(qid, pids): each query's ranked list, for display and export only."""
    return (run.groupBy("qid")
            .agg(F.sort_array(F.collect_list(F.struct("rank", "pid"))).alias("l"))
            .select("qid", F.col("l.pid").alias("pids")))
