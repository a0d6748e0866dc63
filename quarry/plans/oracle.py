"""Independent DuckDB formulations of the catalog's queries.

Written from the definitions (tokenizer, BM25, quantiser, metric formulas),
not from the Spark plans: correlated subqueries and whole-list functions
where the Spark side uses joins and windows. Literals are typed ``::double``
so DuckDB never falls back to DECIMAL arithmetic.
"""

from __future__ import annotations

TOK = "'[A-Za-z0-9]+'"

# BM25 postings over a passage view named {src} with columns (doc_id, text).
POSTINGS_CTE = """
  {p}_d AS (SELECT doc_id, regexp_extract_all(text, {tok}) AS t FROM {src}),
  {p}_stats AS (SELECT count(*) AS n, CAST(coalesce(sum(len(t)), 0) // count(*) AS DOUBLE) AS avgl
                FROM {p}_d),
  {p}_tf AS (SELECT term, doc_id, doc_len, count(*) AS tf
             FROM (SELECT doc_id, len(t) AS doc_len, unnest(t) AS term FROM {p}_d)
             GROUP BY term, doc_id, doc_len),
  {p}_df AS (SELECT term, count(*) AS df FROM {p}_tf GROUP BY term),
  {p}_raw AS (
    SELECT tf.term, tf.doc_id, tf.tf, df.df, tf.doc_len,
           ln((s.n - df.df + 0.5::double) / (df.df + 0.5::double))
           * (((1.2::double + 1.0::double) * tf.tf)
              / (1.2::double * ((1.0::double - 0.75::double)
                                + 0.75::double * (tf.doc_len::double / s.avgl)) + tf.tf)) AS impact
    FROM {p}_tf tf JOIN {p}_df df ON tf.term = df.term, {p}_stats s),
  {p} AS (
    SELECT *, CASE WHEN impact <= 0 THEN 0 WHEN impact >= 30 THEN 255
                   ELSE CAST(floor(impact / 30.0::double * 255.0::double) AS INTEGER) END AS impact_q
    FROM {p}_raw)"""


def postings_cte(name: str, src: str) -> str:
    return POSTINGS_CTE.format(p=name, src=src, tok=TOK)


# Ranked BM25 run {name}(qid, pid, rank, score, score_q) of queries view {qsrc}(qid, text)
# against postings CTE {post}; {having} restricts candidates; {k} the depth.
RUN_CTE = """
  {name}_qt AS (SELECT qid, len(ts) AS n_terms, unnest(ts) AS term
                FROM (SELECT qid, list_distinct(regexp_extract_all(text, {tok})) AS ts FROM {qsrc})),
  {name}_s AS (SELECT q.qid, p.doc_id, CAST(sum(p.impact_q) AS BIGINT) AS score_q
               FROM {name}_qt q JOIN {post} p ON p.term = q.term
               GROUP BY q.qid, p.doc_id, q.n_terms {having}),
  {name} AS (SELECT qid, doc_id AS pid,
                    CAST(row_number() OVER (PARTITION BY qid ORDER BY score_q DESC, doc_id) AS BIGINT) AS rank,
                    round(score_q * 30.0::double / 255.0::double, 6) AS score, score_q
             FROM {name}_s
             QUALIFY row_number() OVER (PARTITION BY qid ORDER BY score_q DESC, doc_id) <= {k})"""


def run_cte(name: str, qsrc: str, post: str, k: int, mode: str = "or") -> str:
    having = "HAVING count(*) = q.n_terms" if mode == "and" else ""
    return RUN_CTE.format(name=name, qsrc=qsrc, post=post, k=k, having=having, tok=TOK)


QUERIES_VIEW = "kq AS (SELECT item_id AS qid, text FROM benchmark)"


# Judgments: containment (grade 1) and pooled graded judgments; needs a run CTE named {run}.
JUDG_CTE = """
  contain AS (SELECT b.item_id AS qid, d.doc_id AS pid, 1 AS rel
              FROM benchmark b JOIN documents d ON contains(d.text, b.text)),
  graded AS (
    SELECT c.qid, c.pid, 2 + coalesce(l.quality, 0) AS rel
    FROM contain c LEFT JOIN labels l ON l.doc_id = c.pid
    UNION ALL
    SELECT r.qid, r.pid, l.quality AS rel
    FROM {run} r JOIN labels l ON l.doc_id = r.pid
    WHERE r.rank <= {pool}
      AND NOT EXISTS (SELECT 1 FROM contain c WHERE c.qid = r.qid AND c.pid = r.pid))"""


def judgments_cte(run: str, pool: int) -> str:
    return JUDG_CTE.format(run=run, pool=pool)


# Per-query metric table over run CTE {run} truncated at {k}, judgments CTE {qrels}.
PER_QUERY_CTE = """
  {p}_r AS (SELECT qid, pid, rank FROM {run} WHERE rank <= {k}),
  {p}_hits AS (SELECT r.qid, r.rank FROM {p}_r r JOIN {qrels} g
               ON g.qid = r.qid AND g.pid = r.pid WHERE g.rel > 0),
  {p}_hitagg AS (
    SELECT h.qid, count(*) AS n_hits, min(h.rank) AS first_hit,
           sum((SELECT count(*) FROM {p}_hits h2 WHERE h2.qid = h.qid AND h2.rank <= h.rank)
               / h.rank::double) AS sum_prec
    FROM {p}_hits h GROUP BY h.qid),
  {p}_nrel AS (SELECT qid, count(*) AS n_rel FROM {qrels} WHERE rel > 0 GROUP BY qid),
  {p}_gains AS (
    SELECT r.qid, sum((pow(2.0::double, coalesce(g.rel, 0)) - 1.0::double) / log2(r.rank + 1.0::double)) AS dcg,
           list_sort(list(coalesce(g.rel, 0)), 'DESC') AS srt
    FROM {p}_r r LEFT JOIN {qrels} g ON g.qid = r.qid AND g.pid = r.pid GROUP BY r.qid),
  {p}_ideal AS (
    SELECT qid, dcg, list_sum(list_transform(generate_series(1, len(srt)),
             lambda i: (pow(2.0::double, srt[i]) - 1.0::double) / log2(i + 1.0::double))) AS idcg
    FROM {p}_gains),
  {p} AS (
    SELECT i.qid, n.n_rel, coalesce(h.n_hits, 0) AS n_hits,
           1.0::double / h.first_hit AS rr,
           CASE WHEN n.n_rel IS NOT NULL THEN coalesce(h.n_hits, 0) / n.n_rel::double END AS recall,
           CASE WHEN n.n_rel IS NOT NULL THEN coalesce(h.sum_prec, 0.0::double) / n.n_rel END AS ap,
           CASE WHEN i.idcg > 0 THEN i.dcg / i.idcg ELSE 0.0::double END AS ndcg
    FROM {p}_ideal i LEFT JOIN {p}_hitagg h ON h.qid = i.qid LEFT JOIN {p}_nrel n ON n.qid = i.qid)"""


def per_query_cte(p: str, run: str, qrels: str, k: int) -> str:
    return PER_QUERY_CTE.format(p=p, run=run, qrels=qrels, k=k)


METRIC_COL = {"mrr": "rr", "recall": "recall", "map": "ap", "ndcg": "ndcg"}


# Vector side. Inner products on double[] (elements widened exactly from float).
def ip(a: str, b: str) -> str:
    return f"list_inner_product({a}::double[], {b}::double[])"


def cos(a: str, b: str) -> str:
    den = f"(sqrt({ip(a, a)}) * sqrt({ip(b, b)}))"
    return f"(CASE WHEN {den} = 0 THEN 0.0::double ELSE {ip(a, b)} / {den} END)"


QVEC_CTE = """
  qv AS (SELECT vec_id AS qid, embedding FROM embeddings WHERE vec_id IN (SELECT item_id FROM benchmark))"""

KNN_CTE = """
  {name}_s AS (SELECT q.qid, p.vec_id AS pid, {score} AS score FROM qv q, embeddings p),
  {name} AS (SELECT qid, pid, CAST(row_number() OVER (PARTITION BY qid ORDER BY score DESC, pid) AS BIGINT) AS rank,
                    score FROM {name}_s
             QUALIFY row_number() OVER (PARTITION BY qid ORDER BY score DESC, pid) <= {k})"""


def knn_cte(name: str, k: int) -> str:
    return KNN_CTE.format(name=name, k=k, score=ip("q.embedding", "p.embedding"))


IVF_CTE = """
  piv AS (SELECT cell_id, c FROM (SELECT row_number() OVER (ORDER BY vec_id) - 1 AS cell_id, embedding AS c
                                  FROM embeddings) WHERE cell_id < {cells}),
  cellof AS (SELECT id, cell_id FROM (
               SELECT e.vec_id AS id, piv.cell_id, {pscore} AS s FROM embeddings e, piv)
             QUALIFY row_number() OVER (PARTITION BY id ORDER BY s DESC, cell_id) <= {assign_k}),
  probe AS (SELECT qid, cell_id FROM (
              SELECT q.qid, piv.cell_id, {qscore} AS s FROM qv q, piv)
            QUALIFY row_number() OVER (PARTITION BY qid ORDER BY s DESC, cell_id) <= {nprobe}),
  ann_s AS (SELECT DISTINCT pr.qid, e.vec_id AS pid, {cscore} AS score
            FROM probe pr JOIN cellof co ON co.cell_id = pr.cell_id
            JOIN embeddings e ON e.vec_id = co.id JOIN qv q ON q.qid = pr.qid),
  ann AS (SELECT qid, pid, CAST(row_number() OVER (PARTITION BY qid ORDER BY score DESC, pid) AS BIGINT) AS rank,
                 score FROM ann_s
          QUALIFY row_number() OVER (PARTITION BY qid ORDER BY score DESC, pid) <= {k})"""


def ivf_cte(cells: int, nprobe: int, k: int, assign_k: int = 1) -> str:
    return IVF_CTE.format(cells=cells, nprobe=nprobe, k=k, assign_k=assign_k, pscore=ip("e.embedding", "piv.c"),
                          qscore=ip("q.embedding", "piv.c"), cscore=ip("q.embedding", "e.embedding"))


SUBSET_VIEW = "sub AS (SELECT doc_id, text FROM documents WHERE doc_id IN (SELECT vec_id FROM embeddings))"

RERANK_CTE = """
  {name}_j AS (SELECT r.qid, r.pid, r.rank AS orig_rank, {score} AS score
               FROM {run} r JOIN qv q ON q.qid = r.qid JOIN embeddings p ON p.vec_id = r.pid
               WHERE r.rank <= {k}),
  {name} AS (SELECT qid, pid, CAST(row_number() OVER (PARTITION BY qid ORDER BY score DESC, orig_rank) AS BIGINT)
                    AS rank, score, orig_rank FROM {name}_j)"""


def rerank_cte(name: str, run: str, k: int) -> str:
    return RERANK_CTE.format(name=name, run=run, k=k, score=cos("q.embedding", "p.embedding"))


# ---------------------------------------------------------------- systems and their evaluation

CONTAIN_CTE = """
  contain AS (SELECT b.item_id AS qid, d.doc_id AS pid, 1 AS rel
              FROM benchmark b JOIN documents d ON contains(d.text, b.text))"""

GRADED_CTE = """
  {name} AS (
    SELECT c.qid, c.pid, 2 + coalesce(l.quality, 0) AS rel
    FROM contain c LEFT JOIN labels l ON l.doc_id = c.pid
    UNION ALL
    SELECT r.qid, r.pid, l.quality AS rel
    FROM {run} r JOIN labels l ON l.doc_id = r.pid
    WHERE r.rank <= {pool}
      AND NOT EXISTS (SELECT 1 FROM contain c WHERE c.qid = r.qid AND c.pid = r.pid))"""

QRELS_SETS_CTE = """
  qr AS (SELECT 'dev' AS eval_set, qid, pid, rel FROM contain
         UNION ALL SELECT 'eval_one', qid, pid, rel FROM g1
         UNION ALL SELECT 'eval_two', qid, pid, rel FROM g2),
  qsets AS (SELECT DISTINCT eval_set, qid FROM qr)"""


def judgment_sets_ctes(pool: int) -> list[str]:
    return [postings_cte("postf", "documents"), QUERIES_VIEW, run_cte("runf", "kq", "postf", pool),
            QVEC_CTE, knn_cte("knnp", pool), CONTAIN_CTE,
            GRADED_CTE.format(name="g1", run="runf", pool=pool),
            GRADED_CTE.format(name="g2", run="knnp", pool=pool), QRELS_SETS_CTE]


def system_run_ctes(system: str, depth: int) -> tuple[list[str], str]:
    """CTEs producing the system's run over all queries, and the CTE name."""
    if system == "bm25":
        return [SUBSET_VIEW, postings_cte("post", "sub"), run_cte("runs", "kq", "post", depth)], "runs"
    if system == "ann":
        return [knn_cte("ann", depth)], "ann"      # the index is read until its bounds make the run exact
    if system == "cascade":
        ctes, base = system_run_ctes("bm25", depth)
        return ctes + [rerank_cte("casc", base, depth)], "casc"
    raise ValueError(system)


def evaluation_sql(systems: list[str], spec, depth: int, pool: int) -> tuple[list[str], list[str]]:
    """(ctes, per-cell SELECTs) computing (system, eval_set, metric, k, value)."""
    ctes = judgment_sets_ctes(pool)
    seen = set()
    selects = []
    for system in systems:
        sctes, run = system_run_ctes(system, depth)
        for c in sctes:
            if c not in seen:
                ctes.append(c)
                seen.add(c)
        for s in sorted({s for s, _, _ in spec}):
            ctes.append(f"r_{system}_{s} AS (SELECT r.qid, r.pid, r.rank FROM {run} r "
                        f"WHERE r.qid IN (SELECT qid FROM qsets WHERE eval_set = '{s}'))")
            if f"qr_{s}" not in seen:
                ctes.append(f"qr_{s} AS (SELECT qid, pid, rel FROM qr WHERE eval_set = '{s}')")
                seen.add(f"qr_{s}")
            for k in sorted({k for ss, _, k in spec if ss == s}):
                ctes.append(per_query_cte(f"pq_{system}_{s}_{k}", f"r_{system}_{s}", f"qr_{s}", k))
            for ss, m, k in spec:
                if ss == s:
                    selects.append(
                        f"SELECT '{system}' AS system, '{s}' AS eval_set, '{m}' AS metric, "
                        f"CAST({k} AS BIGINT) AS k, coalesce(avg({METRIC_COL[m]}), 0.0) AS value "
                        f"FROM pq_{system}_{s}_{k}")
    return ctes, selects
