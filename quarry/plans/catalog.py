"""Registered queries: one per operator row of the survey's inventory.

Each entry is ``name -> (builder(spark, sf_dir) -> DataFrame, oracle SQL or None)``.
Builders read the driver's tables whole; output columns are aliased to the
same names as the SQL. Doubles that are not exact are rounded to 6 decimals
in the output only, never inside the computation.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators import ann as AN
from quarry.operators import bounded as BD
from quarry.operators import filters as FL
from quarry.operators import index as IX
from quarry.operators import knn as KN
from quarry.operators import metrics as M
from quarry.operators import neighbor_graph as NG
from quarry.operators import norm_blocks as NB
from quarry.operators import rerank as RR
from quarry.operators import search as S
from quarry.operators import segments as SG
from quarry.operators import term_ids as TI
from quarry.operators import vector_table as VP
from quarry.operators import vector_tree as VT
from quarry.plans import judgments as J
from quarry.plans import oracle as O
from quarry.plans import systems as PL
from quarry.session import materialize, scratch_path, table_path
from quarry.sources import judgments as SJ
from quarry.sources import runs as SR
from quarry.sources import tables as TB
from quarry.sources import tsv as ST
from quarry.sources import vectors as SV

Builder = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[Builder, str | None]] = {}

DEPTH = 1000       # run depth of the registered keyword queries
METRIC_DEPTH = 100  # depth of the per-query metrics
POOL = 20    # judgment pool depth (graded judgments)


def register(name: str, sql: str | None):
    def deco(fn: Builder) -> Builder:
        REGISTRY[name] = (fn, sql)
        return fn
    return deco


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n"


# ---------------------------------------------------------------- text / index

@register("tok_docs", f"""
SELECT doc_id, CAST(generate_subscripts(t, 1) AS BIGINT) AS pos, unnest(t) AS token
FROM (SELECT doc_id, regexp_extract_all(text, {O.TOK}) AS t FROM documents)
""")
def q_tok_docs(spark, sf):
    return IX.token_rows(TB.passages(spark, sf))


@register("tok_queries", f"""
SELECT item_id AS qid, CAST(len(ts) AS BIGINT) AS n_terms, unnest(ts) AS term
FROM (SELECT item_id, list_distinct(regexp_extract_all(text, {O.TOK})) AS ts FROM benchmark)
""")
def q_tok_queries(spark, sf):
    return S.query_terms(TB.keyword_queries(spark, sf))


@register("doc_lengths", f"""
SELECT doc_id, CAST(len(regexp_extract_all(text, {O.TOK})) AS BIGINT) AS doc_len FROM documents
""")
def q_doc_lengths(spark, sf):
    return IX.doc_lengths(TB.passages(spark, sf))


@register("term_freq", f"""
SELECT term, doc_id, count(*) AS tf
FROM (SELECT doc_id, unnest(regexp_extract_all(text, {O.TOK})) AS term FROM documents)
GROUP BY term, doc_id
""")
def q_term_freq(spark, sf):
    return IX.term_freq(TB.passages(spark, sf))


@register("doc_freq", f"""
SELECT term, count(DISTINCT doc_id) AS df
FROM (SELECT doc_id, unnest(regexp_extract_all(text, {O.TOK})) AS term FROM documents)
GROUP BY term
""")
def q_doc_freq(spark, sf):
    return IX.doc_freq(IX.term_freq(TB.passages(spark, sf)))


@register("coll_stats", f"""
SELECT count(*) AS n_docs, CAST(sum(l) AS BIGINT) AS total_len,
       CAST(floor(sum(l) / count(*)) AS DOUBLE) AS avg_len
FROM (SELECT len(regexp_extract_all(text, {O.TOK})) AS l FROM documents)
""")
def q_coll_stats(spark, sf):
    return IX.collection_stats(IX.doc_lengths(TB.passages(spark, sf)))


@register("coll_stats_exact", f"""
SELECT count(*) AS n_docs, CAST(sum(l) AS BIGINT) AS total_len,
       round(sum(l)::double / count(*)::double, 6) AS avg_len
FROM (SELECT len(regexp_extract_all(text, {O.TOK})) AS l FROM documents)
""")
def q_coll_stats_exact(spark, sf):
    return _round_cols(IX.collection_stats(IX.doc_lengths(TB.passages(spark, sf)), "exact"), {"avg_len"})


@register("vocabulary", f"""
SELECT DISTINCT unnest(regexp_extract_all(text, {O.TOK})) AS term FROM documents
""")
def q_vocabulary(spark, sf):
    return IX.vocabulary(IX.term_freq(TB.passages(spark, sf)))


@register("postings", _with(O.postings_cte("post", "documents")) + """
SELECT term, doc_id, tf, df, doc_len, round(impact, 6) AS impact, impact_q FROM post
""")
def q_postings(spark, sf):
    p = IX.build_postings(TB.passages(spark, sf))
    return p.withColumn("impact", F.round("impact", 6))


@register("lexicon", f"""
SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS cf
FROM (SELECT term, doc_id, count(*) AS tf
      FROM (SELECT doc_id, unnest(regexp_extract_all(text, {O.TOK})) AS term FROM documents) GROUP BY term, doc_id)
GROUP BY term
""")
def q_lexicon(spark, sf):
    return IX.lexicon(IX.term_freq(TB.passages(spark, sf)))


@register("posting_profile", f"""
SELECT term, count(*) AS n_postings, min(doc_id) AS first_doc, max(doc_id) AS last_doc, max(tf) AS max_tf
FROM (SELECT term, doc_id, count(*) AS tf
      FROM (SELECT doc_id, unnest(regexp_extract_all(text, {O.TOK})) AS term FROM documents) GROUP BY term, doc_id)
GROUP BY term
""")
def q_posting_profile(spark, sf):
    return IX.posting_profile(IX.term_freq(TB.passages(spark, sf)))


# ---------------------------------------------------------------- keyword search

def _bm25_sql(mode: str, k: int) -> str:
    return _with(O.postings_cte("post", "documents"), O.QUERIES_VIEW,
                 O.run_cte("run", "kq", "post", k, mode)) + \
        "SELECT qid, pid, rank, score, score_q FROM run\n"


@register("bm25_or", _bm25_sql("or", DEPTH))
def q_bm25_or(spark, sf):
    return IX.TextIndex.build(TB.passages(spark, sf)).search(TB.keyword_queries(spark, sf), k=DEPTH, mode="or")


@register("bm25_pages", _with(O.postings_cte("post", "pg"), O.QUERIES_VIEW,
                              O.run_cte("run", "kq", "post", DEPTH)).replace(
    "WITH ", "WITH pg AS (SELECT page_id AS doc_id, html AS text FROM pages),\n", 1)
          + "SELECT qid, pid, rank, score, score_q FROM run\n")
def q_bm25_pages(spark, sf):
    """The keyword batch against every raw HTML page (tokenizer stress)."""
    return IX.TextIndex.build(TB.pages(spark, sf)).search(TB.keyword_queries(spark, sf), k=DEPTH)


@register("bm25_and", _bm25_sql("and", DEPTH))
def q_bm25_and(spark, sf):
    return IX.TextIndex.build(TB.passages(spark, sf)).search(TB.keyword_queries(spark, sf), k=DEPTH, mode="and")


# ---------------------------------------------------------------- shared inputs

def _run(spark, sf, k=DEPTH, index=None):
    """The keyword run, searched once and written: every reader of it reads the copy."""
    index = index or IX.TextIndex.build(TB.passages(spark, sf))
    return materialize(index.search(TB.keyword_queries(spark, sf), k=k), "run")


def _contain(spark, sf, index=None):
    return J.containment_qrels(TB.passages(spark, sf), TB.keyword_queries(spark, sf), index=index)


def _judged_run(spark, sf, run=None):
    """(run, judgments), both written: one index serves the run and the containment test. ``run``: a written run."""
    index = IX.TextIndex.build(TB.passages(spark, sf))
    run = run if run is not None else _run(spark, sf, index=index)
    contain = materialize(_contain(spark, sf, index), "containment")
    return run, materialize(J.graded_qrels(contain, run, TB.labels(spark, sf), POOL), "judgments")


def _graded(spark, sf, run=None):
    return _judged_run(spark, sf, run)[1]


def _sql_base() -> list[str]:
    return [O.postings_cte("post", "documents"), O.QUERIES_VIEW,
            O.run_cte("run", "kq", "post", DEPTH), O.judgments_cte("run", POOL)]


# ---------------------------------------------------------------- judgments and filters

@register("qrels_contain", _with(O.judgments_cte("run", POOL).split("graded AS")[0].rstrip().rstrip(","))
          + "SELECT qid, pid, rel FROM contain\n")
def q_qrels_contain(spark, sf):
    return _contain(spark, sf)


@register("qrels_graded", _with(*_sql_base()) + "SELECT qid, pid, rel FROM graded\n")
def q_qrels_graded(spark, sf):
    return _graded(spark, sf)


@register("qrels_relevant", _with(*_sql_base()) + "SELECT qid, pid, rel FROM graded WHERE rel > 0\n")
def q_qrels_relevant(spark, sf):
    return M.relevant(_graded(spark, sf))


@register("judged_queries", _with(*_sql_base()) + "SELECT DISTINCT qid FROM graded\n")
def q_judged_queries(spark, sf):
    return FL.judged_queries(_graded(spark, sf))


@register("subset_docs", """
SELECT doc_id, text FROM documents WHERE doc_id IN (SELECT vec_id FROM embeddings)
""")
def q_subset_docs(spark, sf):
    return FL.subset_by_ids(TB.passages(spark, sf), TB.vectors(spark, sf), "doc_id", "id")


@register("subset_queries", """
SELECT item_id AS qid, text FROM benchmark b
WHERE EXISTS (SELECT 1 FROM documents d WHERE contains(d.text, b.text))
""")
def q_subset_queries(spark, sf):
    return FL.subset_by_ids(TB.keyword_queries(spark, sf), _contain(spark, sf), "qid")


@register("subset_query_vectors", """
SELECT vec_id AS id, label FROM embeddings e
WHERE EXISTS (SELECT 1 FROM benchmark b JOIN documents d ON contains(d.text, b.text)
              WHERE b.item_id = e.vec_id)
""")
def q_subset_query_vectors(spark, sf):
    vecs = TB.table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), "label")
    return FL.subset_by_ids(vecs, _contain(spark, sf), "id", "qid")


@register("run_truncated", _with(*_sql_base()[:3]) + "SELECT qid, pid, rank, score FROM run WHERE rank <= 10\n")
def q_run_truncated(spark, sf):
    return M.truncate_run(_run(spark, sf), 10).select("qid", "pid", "rank", "score")


@register("run_lists", _with(*_sql_base()[:3]) + """
SELECT qid, CAST(count(*) AS BIGINT) AS n, string_agg(CAST(pid AS VARCHAR), ',' ORDER BY rank) AS pids
FROM run GROUP BY qid
""")
def q_run_lists(spark, sf):
    lists = M.run_lists(_run(spark, sf))
    return lists.select("qid", F.size("pids").cast("bigint").alias("n"),
                        F.concat_ws(",", F.col("pids").cast("array<string>")).alias("pids"))


# ---------------------------------------------------------------- evaluation

def _round_cols(df, cols):
    return df.select(*[F.round(c, 6).alias(c) if c in cols else F.col(c) for c in df.columns])


@register("per_query", _with(*_sql_base(), O.per_query_cte("pq", "run", "graded", METRIC_DEPTH)) + """
SELECT qid, n_rel, n_hits, round(rr, 6) AS rr, round(recall, 6) AS recall,
       round(ap, 6) AS ap, round(ndcg, 6) AS ndcg FROM pq
""")
def q_per_query(spark, sf):
    run, graded = _judged_run(spark, sf)
    per = M.per_query_metrics(run, graded, METRIC_DEPTH)
    return _round_cols(per, {"rr", "recall", "ap", "ndcg"})


def _metric_sql(metric: str, k: int) -> str:
    col = O.METRIC_COL[metric]
    return _with(*_sql_base(), O.per_query_cte("pq", "run", "graded", k)) + f"""
SELECT '{metric}' AS metric, CAST({k} AS BIGINT) AS k, round(coalesce(avg({col}), 0.0), 6) AS value FROM pq
"""


def _metric_builder(metric: str, k: int):
    def build(spark, sf):
        run, graded = _judged_run(spark, sf)
        per = M.per_query_metrics(run, graded, k)
        return _round_cols(M.aggregate_metric(per, metric, k), {"value"})
    return build


for _name, _metric, _k in [("mrr", "mrr", 10), ("recall", "recall", 100),
                           ("map", "map", 100), ("ndcg", "ndcg", 10)]:
    register(_name, _metric_sql(_metric, _k))(_metric_builder(_metric, _k))


@register("precision_at_hits", _with(*_sql_base()) + f"""
, r AS (SELECT qid, pid, rank FROM run WHERE rank <= {METRIC_DEPTH}),
h AS (SELECT r.qid, r.pid, r.rank FROM r JOIN graded g ON g.qid = r.qid AND g.pid = r.pid WHERE g.rel > 0)
SELECT h.qid, h.rank, h.pid,
       round((SELECT count(*) FROM h h2 WHERE h2.qid = h.qid AND h2.rank <= h.rank) / h.rank::double, 6)
       AS precision
FROM h
""")
def q_precision_at_hits(spark, sf):
    run, graded = _judged_run(spark, sf)
    return _round_cols(M.precision_at_hits(run, graded, METRIC_DEPTH), {"precision"})


# ---------------------------------------------------------------- sources and sinks (round trips)

@register("tsv_docs", """
SELECT doc_id, regexp_replace(text, '[\\r\\n]', ' ', 'g') AS text FROM documents
""")
def q_tsv_docs(spark, sf):
    path = scratch_path(spark, "tsv-docs")
    ST.write_id_text_tsv(TB.passages(spark, sf), path, "doc_id", "text")
    return ST.read_id_text_tsv(spark, path, "doc_id", "text")


@register("tsv_queries", """
SELECT item_id AS qid, regexp_replace(text, '[\\r\\n]', ' ', 'g') AS text FROM benchmark
""")
def q_tsv_queries(spark, sf):
    path = scratch_path(spark, "tsv-queries")
    ST.write_id_text_tsv(TB.keyword_queries(spark, sf), path, "qid", "text")
    return ST.read_id_text_tsv(spark, path, "qid", "text")


@register("qrels_triples", _with(*_sql_base()) + "SELECT qid, pid, rel FROM graded\n")
def q_qrels_triples(spark, sf):
    path = scratch_path(spark, "qrels-triples")
    SJ.write_qrels(_graded(spark, sf), path, "triples")
    return SJ.read_qrels(spark, path, "triples", validate=True)


@register("qrels_trec", _with(*_sql_base()) + "SELECT qid, pid, rel FROM graded\n")
def q_qrels_trec(spark, sf):
    path = scratch_path(spark, "qrels-trec")
    SJ.write_qrels(_graded(spark, sf), path, "trec")
    return SJ.read_qrels(spark, path, "trec", validate=True)


@register("vectors_loaded", """
SELECT vec_id AS id, CAST(len(embedding) AS INTEGER) AS dim,
       round(list_sum(list_transform(embedding, lambda x: x::double)), 6) AS total
FROM embeddings
""")
def q_vectors_loaded(spark, sf):
    v = SV.read_vectors(spark, table_path(sf, "embeddings"), "vec_id", "embedding", dim=64)
    total = F.aggregate("embedding", F.lit(0.0), lambda acc, x: acc + x.cast("double"))
    return v.select("id", F.size("embedding").alias("dim"), F.round(total, 6).alias("total"))


@register("run_saved", _with(*_sql_base()[:3]) + "SELECT qid, pid, rank FROM run\n")
def q_run_saved(spark, sf):
    path = scratch_path(spark, "run-tsv2")
    SR.write_run(_run(spark, sf), path, "tsv2")
    return SR.read_run(spark, path, "tsv2")


@register("run_parquet", _with(*_sql_base()[:3]) + "SELECT qid, pid, rank, score FROM run\n")
def q_run_parquet(spark, sf):
    path = scratch_path(spark, "run-parquet")
    SR.write_run(_run(spark, sf), path, "parquet")
    return SR.read_run(spark, path, "parquet")


@register("run_tsv", _with(*_sql_base()[:3]) + "SELECT qid, pid, rank, score FROM run\n")
def q_run_tsv(spark, sf):
    path = scratch_path(spark, "run-tsv")
    SR.write_run(_run(spark, sf), path, "tsv")
    return SR.read_run(spark, path, "tsv")


@register("run_cached", _with(*_sql_base()[:3]) + "SELECT qid, pid, rank, score FROM run\n")
def q_run_cached(spark, sf):
    path = scratch_path(spark, "run-cached")
    first = SR.load_or_build_run(spark, path, lambda: _run(spark, sf))
    # second call must reuse the saved files rather than rebuild
    return SR.load_or_build_run(spark, path, lambda: first.limit(0))


@register("index_saved", _bm25_sql("or", DEPTH))
def q_index_saved(spark, sf):
    path = scratch_path(spark, "text-index")
    IX.TextIndex.build(TB.passages(spark, sf)).save(path)
    idx = IX.TextIndex.load(spark, path)
    return idx.search(TB.keyword_queries(spark, sf), k=DEPTH, mode="or")


@register("bm25_or_bounded", _bm25_sql("or", DEPTH))
def q_bm25_or_bounded(spark, sf):
    """Postings of frequent terms read only where a document can still enter the result."""
    idx = BD.BoundedIndex.build(IX.TextIndex.build(TB.passages(spark, sf)))
    return idx.search(TB.keyword_queries(spark, sf), k=DEPTH)


@register("bm25_or_bounded_top10", _bm25_sql("or", 10))
def q_bm25_or_bounded_top10(spark, sf):
    idx = BD.BoundedIndex.build(IX.TextIndex.build(TB.passages(spark, sf)))
    return idx.search(TB.keyword_queries(spark, sf), k=10)


@register("index_segments", _bm25_sql("or", DEPTH))
def q_index_segments(spark, sf):
    """Two segments, documents of other texts replaced and strangers deleted: as one fresh index of the table."""
    docs = TB.passages(spark, sf)
    idx = SG.SegmentedIndex(spark, scratch_path(spark, "segments"))
    early = F.xxhash64("doc_id") > 0
    strangers = docs.select((-1 - F.col("doc_id")).alias("doc_id"), "text")
    idx.add(docs.where(early).unionByName(strangers))
    idx.add(docs.where(~early).select("doc_id", F.reverse("text").alias("text")))
    idx.delete(strangers.select("doc_id"))
    idx.add(docs.where(~early))
    return idx.search(TB.keyword_queries(spark, sf), k=DEPTH)


@register("term_ids", _with(O.postings_cte("post", "documents")) + """
SELECT term, CAST(row_number() OVER (ORDER BY term) - 1 AS BIGINT) AS term_id FROM (SELECT DISTINCT term FROM post)
""")
def q_term_ids(spark, sf):
    return TI.term_ids(IX.term_freq(TB.passages(spark, sf)))


@register("postings_by_id", _with(O.postings_cte("post", "documents")) + """
, ids AS (SELECT term, CAST(row_number() OVER (ORDER BY term) - 1 AS BIGINT) AS term_id
          FROM (SELECT DISTINCT term FROM post))
SELECT i.term_id, p.doc_id, CAST(p.tf AS BIGINT) AS tf FROM post p JOIN ids i USING (term)
""")
def q_postings_by_id(spark, sf):
    tf = IX.term_freq(TB.passages(spark, sf))
    return TI.with_term_ids(tf.select("term", "doc_id", "tf"), TI.term_ids(tf)).select("term_id", "doc_id", "tf")


# ---------------------------------------------------------------- vector retrieval and rerank

KNN_K = 10       # neighbours per query vector
N_CELLS = 16     # inverted-file cells
NPROBE = 4       # cells probed per query
RERANK_K = 1000  # depth of the keyword run that is re-ranked


def _query_vectors(spark, sf):
    """(qid, embedding): vectors of the keyword queries (benchmark items)."""
    vecs = TB.vectors(spark, sf)
    return FL.subset_by_ids(vecs, TB.keyword_queries(spark, sf), "id", "qid") \
        .select(F.col("id").alias("qid"), "embedding")


def _ivf(spark, sf):
    return AN.VectorIndex.build(TB.vectors(spark, sf), N_CELLS, train="pivots")


def _knn(spark, sf, k=KNN_K):
    return KN.knn_exact(TB.vectors(spark, sf), _query_vectors(spark, sf), k)


def _subset_run(spark, sf, k=RERANK_K):
    return IX.TextIndex.build(PL.saved_subset_passages(spark, sf)).search(TB.keyword_queries(spark, sf), k=k)


@register("knn_exact", _with(O.QVEC_CTE, O.knn_cte("knn", KNN_K))
          + "SELECT qid, pid, rank, round(score, 6) AS score FROM knn\n")
def q_knn_exact(spark, sf):
    return _round_cols(_knn(spark, sf), {"score"})


@register("ann_assign", _with(O.QVEC_CTE, O.ivf_cte(N_CELLS, NPROBE, KNN_K).split("probe AS")[0]
                              .rstrip().rstrip(","))
          + "SELECT CAST(cell_id AS BIGINT) AS cell_id, id FROM cellof\n")
def q_ann_assign(spark, sf):
    return _ivf(spark, sf).assignment.select(F.col("cell_id").cast("bigint"), "id")


def _knn_sql(k: int) -> str:
    return _with(O.QVEC_CTE, O.knn_cte("knn", k)) + "SELECT qid, pid, rank, round(score, 6) AS score FROM knn\n"


@register("ann_pivots", _with(O.QVEC_CTE, O.ivf_cte(N_CELLS, NPROBE, KNN_K))
          + "SELECT qid, pid, rank, round(score, 6) AS score FROM ann\n")
def q_ann_pivots(spark, sf):
    """The mode whose cells SQL can name: smallest ids as centroids, a fixed number of them probed, low recall."""
    return _round_cols(_ivf(spark, sf).search(_query_vectors(spark, sf), KNN_K, NPROBE), {"score"})


@register("ann_search", _knn_sql(KNN_K))
def q_ann_search(spark, sf):
    """Trained cells, read until the bounds say that no other cell can hold a nearer vector: exact."""
    tree = VT.VectorTree.build(TB.vectors(spark, sf))
    return _round_cols(tree.search(_query_vectors(spark, sf), KNN_K), {"score"})


@register("ann_search_deep", _knn_sql(100))
def q_ann_search_deep(spark, sf):
    tree = VT.VectorTree.build(TB.vectors(spark, sf))
    return _round_cols(tree.search(_query_vectors(spark, sf), 100), {"score"})


@register("ann_saved", _knn_sql(KNN_K))
def q_ann_saved(spark, sf):
    path = scratch_path(spark, "vector-tree")
    VT.VectorTree.build(TB.vectors(spark, sf), path)
    tree = VT.VectorTree.load(spark, path)
    return _round_cols(tree.search(_query_vectors(spark, sf), KNN_K), {"score"})


@register("ann_tree", _knn_sql(KNN_K))
def q_ann_tree(spark, sf):
    """Trained cells, all of them probed: exhaustive search whatever the training."""
    tree = VT.VectorTree.build(TB.vectors(spark, sf))
    run = tree.search(_query_vectors(spark, sf), KNN_K, nprobe=tree.stats().first().cells_used,
                      coarse_probe=len(tree.coarse))
    return _round_cols(run, {"score"})


@register("ann_cells_read", None)
def q_ann_cells_read(spark, sf):
    """(search, k, n_queries, n_cells, share): share of the cells that exact and calibrated searches read."""
    queries = _query_vectors(spark, sf)
    tree = VT.VectorTree.build(TB.vectors(spark, sf), calibrate=((10, 0.95), (100, 0.95)))
    n_cells = tree.stats().first().cells_used
    parts = []
    for name, recall in (("exact", 1.0), ("recall 0.95", 0.95)):
        for k in (10, 100):
            reads = tree.search_with_reads(queries, k, recall)[1]
            parts.append(reads.agg(F.countDistinct("qid").alias("n_queries"), F.count(F.lit(1)).alias("n")).select(
                F.lit(name).alias("search"), F.lit(k).cast("bigint").alias("k"), "n_queries",
                F.lit(n_cells).alias("n_cells"), F.round(F.try_divide("n", F.col("n_queries") * n_cells), 4).alias("share")))
    return reduce(DataFrame.unionByName, parts)


def _pivots_recall_sql() -> str:
    return _with(O.QVEC_CTE, O.knn_cte("knn", KNN_K), O.ivf_cte(N_CELLS, NPROBE, KNN_K)) + f"""
, per AS (SELECT a.qid, count(k.pid) / (SELECT count(*) FROM knn k2 WHERE k2.qid = a.qid)::double AS recall
          FROM (SELECT DISTINCT qid FROM ann) a LEFT JOIN ann x ON x.qid = a.qid
          LEFT JOIN knn k ON k.qid = x.qid AND k.pid = x.pid GROUP BY a.qid)
SELECT 'recall' AS metric, CAST({KNN_K} AS BIGINT) AS k, round(coalesce(avg(recall), 0.0), 6) AS value FROM per
"""


def _pivots_recall(spark, sf):
    approx = _ivf(spark, sf).search(_query_vectors(spark, sf), KNN_K, NPROBE)
    return _round_cols(AN.ann_recall(approx, _knn(spark, sf), KNN_K), {"value"})


@register("ann_recall", _pivots_recall_sql())
def q_ann_recall(spark, sf):
    """Recall of the inverted file against exact search, its value computed on both sides."""
    return _pivots_recall(spark, sf)


@register("ann_calibrated_recall", _with(O.QVEC_CTE, O.knn_cte("near10", 10), O.knn_cte("near100", 100)) + """
SELECT 'recall' AS metric, CAST(10 AS BIGINT) AS k, count(DISTINCT qid) AS n_queries, count(*) AS n_neighbours,
       CAST(0.9 AS DOUBLE) AS floor, true AS reached FROM near10
UNION ALL SELECT 'recall', CAST(100 AS BIGINT), count(DISTINCT qid), count(*), CAST(0.9 AS DOUBLE), true FROM near100
""")
def q_ann_calibrated_recall(spark, sf):
    """Recall of trained cells read in calibrated numbers, against exact search: at least 0.9 at both depths."""
    queries = _query_vectors(spark, sf)
    tree = VT.VectorTree.build(TB.vectors(spark, sf), calibrate=((10, 0.95), (100, 0.95)))
    parts = []
    for k in (10, 100):
        exact = materialize(_knn(spark, sf, k), "exact")
        size = exact.agg(F.countDistinct("qid").alias("n_queries"), F.count(F.lit(1)).alias("n_neighbours"))
        parts.append(AN.ann_recall(tree.search(queries, k, recall=0.95), exact, k).crossJoin(size).select(
            "metric", "k", "n_queries", "n_neighbours", F.lit(0.9).alias("floor"), (F.col("value") >= 0.9).alias("reached")))
    return parts[0].unionByName(parts[1])


@register("ann_graph", "SELECT count(*) AS n_vectors, CAST(0.9 AS DOUBLE) AS floor, true AS reached FROM embeddings\n")
def q_ann_graph(spark, sf):
    """Neighbour graph of every vector by propagation, and whether it holds 0.9 of the exact neighbours."""
    vecs = TB.vectors(spark, sf)
    graph = NG.neighbor_graph(vecs, m=KNN_K)
    return NG.graph_recall(vecs, graph, KNN_K).select(
        "n_vectors", F.lit(0.9).alias("floor"), (F.col("recall") >= 0.9).alias("reached"))


@register("knn_norm_blocks", _knn_sql(KNN_K))
def q_knn_norm_blocks(spark, sf):
    """Exact search over blocks of descending norm, small enough here for several blocks."""
    blocks = NB.NormBlocks.build(TB.vectors(spark, sf), block_rows=256)
    return _round_cols(blocks.search(_query_vectors(spark, sf), KNN_K), {"score"})


@register("ann_pivots_recall", _pivots_recall_sql())
def q_ann_pivots_recall(spark, sf):
    return _pivots_recall(spark, sf)


@register("ann_stats", _with(O.QVEC_CTE, O.ivf_cte(N_CELLS, NPROBE, KNN_K).split("probe AS")[0]
                             .rstrip().rstrip(",")) + f"""
, occ AS (SELECT cell_id, count(*) AS n FROM cellof GROUP BY cell_id)
SELECT (SELECT count(DISTINCT id) FROM cellof) AS n_vectors, (SELECT count(*) FROM cellof) AS n_entries,
       (SELECT CAST(max(len(embedding)) AS BIGINT) FROM embeddings) AS dim,
       CAST({N_CELLS} AS BIGINT) AS n_cells, (SELECT count(*) FROM occ) AS cells_used,
       (SELECT min(n) FROM occ) AS min_cell, (SELECT max(n) FROM occ) AS max_cell
""")
def q_ann_stats(spark, sf):
    return _ivf(spark, sf).stats()


@register("ann_pivots_saved", _with(O.QVEC_CTE, O.ivf_cte(N_CELLS, NPROBE, KNN_K))
          + "SELECT qid, pid, rank, round(score, 6) AS score FROM ann\n")
def q_ann_pivots_saved(spark, sf):
    path = scratch_path(spark, "vector-index")
    _ivf(spark, sf).save(path)
    idx = AN.VectorIndex.load(spark, path)
    return _round_cols(idx.search(_query_vectors(spark, sf), KNN_K, NPROBE), {"score"})


@register("ann_kmeans", _with(O.QVEC_CTE, O.knn_cte("knn", KNN_K))
          + "SELECT qid, pid, rank, round(score, 6) AS score FROM knn\n")
def q_ann_kmeans(spark, sf):
    """k-means cells, all of them probed: equals exact search whatever the centroids."""
    idx = AN.VectorIndex.build(TB.vectors(spark, sf), N_CELLS, train="kmeans", iters=10)
    return _round_cols(idx.search(_query_vectors(spark, sf), KNN_K, N_CELLS), {"score"})


@register("knn_grid", _with(O.QVEC_CTE, O.knn_cte("knn", 100))
          + "SELECT qid, pid, rank, round(score, 6) AS score FROM knn\n")
def q_knn_grid(spark, sf):
    """Exact search at k = 100 through the grid of blocks (block sizes far below the default)."""
    out = KN.knn_exact(TB.vectors(spark, sf), _query_vectors(spark, sf), 100, p_block_rows=128, q_block_rows=16)
    return _round_cols(out, {"score"})


@register("ann_pivots_deep", _with(O.QVEC_CTE, O.ivf_cte(N_CELLS, NPROBE, 100))
          + "SELECT qid, pid, rank, round(score, 6) AS score FROM ann\n")
def q_ann_pivots_deep(spark, sf):
    return _round_cols(_ivf(spark, sf).search(_query_vectors(spark, sf), 100, NPROBE), {"score"})


@register("ann_two_cells", _with(O.QVEC_CTE, O.ivf_cte(N_CELLS, NPROBE, KNN_K, assign_k=2))
          + "SELECT qid, pid, rank, round(score, 6) AS score FROM ann\n")
def q_ann_two_cells(spark, sf):
    """Every vector stored in its two best cells."""
    idx = AN.VectorIndex.build(TB.vectors(spark, sf), N_CELLS, train="pivots", assign_k=2)
    return _round_cols(idx.search(_query_vectors(spark, sf), KNN_K, NPROBE), {"score"})


@register("cascade_top100", _with(*O.judgment_sets_ctes(PL.POOL), *O.system_run_ctes("bm25", 100)[0],
                                  O.rerank_cte("rr", "runs", 100))
          + "SELECT s.eval_set, r.qid, r.pid, r.rank, round(r.score, 6) AS score FROM qsets s JOIN rr r ON r.qid = s.qid\n")
def q_cascade_top100(spark, sf):
    return _round_cols(PL.cascade_run_sets(spark, sf, PL.saved_judgment_sets(spark, sf), top=100), {"score"})


@register("cascade_top1000", _with(*O.judgment_sets_ctes(PL.POOL), *O.system_run_ctes("bm25", 1000)[0],
                                   O.rerank_cte("rr", "runs", 1000))
          + "SELECT s.eval_set, r.qid, r.pid, r.rank, round(r.score, 6) AS score FROM qsets s JOIN rr r ON r.qid = s.qid\n")
def q_cascade_top1000(spark, sf):
    return _round_cols(PL.cascade_run_sets(spark, sf, PL.saved_judgment_sets(spark, sf), top=1000), {"score"})


@register("rerank", _with(O.SUBSET_VIEW, O.postings_cte("post", "sub"), O.QUERIES_VIEW,
                          O.run_cte("run", "kq", "post", RERANK_K), O.QVEC_CTE,
                          O.rerank_cte("rr", "run", RERANK_K))
          + "SELECT qid, pid, rank, round(score, 6) AS score, orig_rank FROM rr\n")
def q_rerank(spark, sf):
    out = RR.rerank(_subset_run(spark, sf), _query_vectors(spark, sf), TB.vectors(spark, sf), RERANK_K)
    return _round_cols(out, {"score"})


@register("rerank_placed", _with(O.SUBSET_VIEW, O.postings_cte("post", "sub"), O.QUERIES_VIEW,
                                 O.run_cte("run", "kq", "post", RERANK_K), O.QVEC_CTE,
                                 O.rerank_cte("rr", "run", RERANK_K))
          + "SELECT qid, pid, rank, round(score, 6) AS score, orig_rank FROM rr\n")
def q_rerank_placed(spark, sf):
    """Passage vectors placed by id: no exchange of vectors, and only directories with ids of the run are read."""
    placed = VP.VectorTable.write(TB.vectors(spark, sf))
    return _round_cols(RR.rerank(_subset_run(spark, sf), _query_vectors(spark, sf), placed, RERANK_K), {"score"})


@register("missing_vectors", _with(*_sql_base()[:3]) + """
SELECT qid, pid, rank FROM run WHERE pid NOT IN (SELECT vec_id FROM embeddings)
""")
def q_missing_vectors(spark, sf):
    return RR.missing_vectors(_run(spark, sf), TB.vectors(spark, sf)).select("qid", "pid", "rank")


# ---------------------------------------------------------------- systems, evaluation and comparison

def _matrix_sql(systems) -> str:
    ctes, selects = O.evaluation_sql(systems, PL.SPEC, PL.DEPTH, PL.POOL)
    return (_with(*ctes) + ", matrix AS (\n" + "\nUNION ALL\n".join(selects) + ")\n"
            + "SELECT system, eval_set, metric, k, round(value, 6) AS value FROM matrix\n")


@register("judgment_sets", _with(*O.judgment_sets_ctes(PL.POOL)) + "SELECT eval_set, qid, pid, rel FROM qr\n")
def q_judgment_sets(spark, sf):
    return PL.judgment_sets(spark, sf)


@register("bm25_sets", _with(*O.judgment_sets_ctes(PL.POOL), *O.system_run_ctes("bm25", PL.DEPTH)[0])
          + "SELECT s.eval_set, r.qid, r.pid, r.rank, r.score, r.score_q FROM qsets s JOIN runs r ON r.qid = s.qid\n")
def q_bm25_sets(spark, sf):
    return PL.bm25_run_sets(spark, sf, PL.saved_judgment_sets(spark, sf))


@register("eval_bm25", _matrix_sql(["bm25"]))
def q_eval_bm25(spark, sf):
    return _round_cols(PL.evaluate_bm25(spark, sf), {"value"})


@register("eval_ann", _matrix_sql(["ann"]))
def q_eval_ann(spark, sf):
    return _round_cols(PL.evaluate_ann(spark, sf), {"value"})


@register("eval_cascade", _matrix_sql(["cascade"]))
def q_eval_cascade(spark, sf):
    return _round_cols(PL.evaluate_cascade(spark, sf), {"value"})


@register("eval_matrix", _matrix_sql(PL.SYSTEMS))
def q_eval_matrix(spark, sf):
    return _round_cols(PL.eval_matrix(spark, sf), {"value"})


def _compare_sql() -> str:
    ctes, selects = O.evaluation_sql(PL.SYSTEMS, PL.SPEC, PL.DEPTH, PL.POOL)
    cols = ", ".join(f"round(max(CASE WHEN system = '{s}' THEN value END), 6) AS {s}" for s in PL.SYSTEMS)
    return (_with(*ctes) + ", matrix AS (\n" + "\nUNION ALL\n".join(selects) + ")\n"
            + f"SELECT eval_set, metric, k, {cols} FROM matrix GROUP BY eval_set, metric, k\n")


@register("compare", _compare_sql())
def q_compare(spark, sf):
    return _round_cols(PL.compare_systems(PL.eval_matrix(spark, sf)), set(PL.SYSTEMS))


@register("row_counts", _with(*O.judgment_sets_ctes(PL.POOL), O.SUBSET_VIEW) + """
SELECT 'documents' AS source, count(*) AS n_rows FROM documents
UNION ALL SELECT 'passages_with_vector', count(*) FROM sub
UNION ALL SELECT 'queries', count(*) FROM benchmark
UNION ALL SELECT 'vectors', count(*) FROM embeddings
UNION ALL SELECT 'query_vectors', count(*) FROM qv
UNION ALL SELECT 'qrels_' || eval_set, count(*) FROM qr GROUP BY eval_set
UNION ALL SELECT 'queries_' || eval_set, count(DISTINCT qid) FROM qr GROUP BY eval_set
""")
def q_row_counts(spark, sf):
    return PL.row_counts(spark, sf)
