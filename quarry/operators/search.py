"""Batch BM25 retrieval over a postings table.

All queries of a batch run as one plan: query terms join the postings on
``term``, quantised impacts are summed per ``(qid, doc_id)``, and a ``row_number`` top-k per query becomes Spark's
``WindowGroupLimit`` (a bounded per-partition top-k before the shuffle on
``qid``), so a query that matches every document still ships at most
k rows per partition to its final task.

Over term counts, a batch of bounded size is summed in blocks of documents:
each matched posting is weighted once, whatever the number of queries that
ask for its term, a document's postings are brought together in its bucket,
and numpy adds them up for all queries. A larger batch is summed by an
aggregate over (query, document).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions import text as T
from quarry.operators import packed as PK
from quarry.session import BROADCAST_BYTES, bounded_broadcast, map_bounded, materialize

BLOCK_QUERY_BYTES = 8 << 20    # of (query, term) rows that are numbered for sums in blocks of documents
BLOCK_CELLS = 1 << 19          # (document, query) sums held at a time
BLOCK_PAIRS = 1 << 20          # (posting, query) pairs held at a time
KEPT_ROWS = 1 << 21            # rows of running best documents that a task may hold
SCORE_CELLS = 1 << 21          # (query, score) counts that find each query's score at k before rows are sorted


def query_terms(queries: DataFrame, id_col: str = "qid", text_col: str = "text") -> DataFrame:
    """(qid, term, n_terms): distinct query tokens; token-less queries vanish."""
    toks = T.query_tokens(text_col)
    return (queries.select(F.col(id_col).alias("qid"), toks.alias("terms"))
            .select("qid", F.size("terms").cast("bigint").alias("n_terms"),
                    F.explode("terms").alias("term")))


def topk(scored: DataFrame, k: int | None, group_col: str, order: list[Column],
         rank_col: str = "rank") -> DataFrame:
    """Keep the first k rows per group in ``order``; adds a 1-based BIGINT rank.

    ``order`` must be a total order within a group (end it with a unique id)
    so that ties are broken deterministically.
    """
    w = Window.partitionBy(group_col).orderBy(*order)
    out = scored.withColumn(rank_col, F.row_number().over(w))
    if k is not None:
        out = out.where(F.col(rank_col) <= F.lit(k))
    return out.withColumn(rank_col, F.col(rank_col).cast("bigint"))


def score(postings: DataFrame, qterms: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """(qid, doc_id, n_terms, n_matched, score_q): summed quantised impacts.

    A posting with impact 0 still makes its document a candidate.
    Out-of-lexicon terms fall out of the inner join. ``keys`` are the join
    columns (``term``, plus ``term_bucket`` for a saved index).
    """
    keys = keys or ["term"]
    return (postings.select(*keys, "doc_id", "impact_q")
            .join(qterms, keys)
            .groupBy("qid", "doc_id", "n_terms")
            .agg(F.sum("impact_q").cast("bigint").alias("score_q"),
                 F.count(F.lit(1)).cast("bigint").alias("n_matched")))


def _batch_terms(queries: DataFrame, id_col: str, text_col: str, keys: list[str]) -> DataFrame:
    """(qid, term, n_terms); with extra keys, qid is a struct of (keys..., id)."""
    if keys:
        # fold the extra keys into one query key so one plan serves all sets
        q = queries.withColumn("__qkey", F.struct(*[F.col(c) for c in keys], F.col(id_col)))
        return query_terms(q, "__qkey", text_col)
    return query_terms(queries, id_col, text_col)


def _ranked(scored: DataFrame, k: int, mode: str, keys: list[str], id_col: str) -> DataFrame:
    if mode == "and":
        scored = scored.where(F.col("n_matched") == F.col("n_terms"))
    run = topk(scored, k, "qid", [F.col("score_q").desc(), F.col("doc_id").asc()])
    run = run.select("qid", F.col("doc_id").alias("pid"), "rank",
                     F.round(T.dequantize("score_q"), 6).alias("score"), "score_q")
    if keys:
        run = run.select(*[F.col(f"qid.{c}").alias(c) for c in keys],
                         F.col(f"qid.{id_col}").alias("qid"), "pid", "rank", "score", "score_q")
    return run


def _check(mode: str, k) -> None:
    if mode not in ("or", "and"):
        raise ValueError(f"mode must be 'or' or 'and', got {mode!r}")
    if k is None or k <= 0:
        # a run is always cut at a depth: an uncut ranking would put every
        # candidate of a query (possibly the whole collection) in one group
        raise ValueError("k must be a positive depth")


def bm25_search(postings: DataFrame, queries: DataFrame, k: int = 1000,
                mode: str = "or", id_col: str = "qid", text_col: str = "text",
                extra_keys: list[str] | None = None,
                broadcast_bytes: int | None = BROADCAST_BYTES) -> DataFrame:
    """Run (qid, pid, rank, score, score_q) for a batch of queries over weighted postings.

    ``postings`` carry ``impact_q`` (``build_postings``). ``mode='or'``: any
    matched term makes a candidate. ``mode='and'``: every distinct query
    term (including ones absent from the index) must match. Ties go to the
    smaller ``doc_id``. ``extra_keys`` (e.g. an evaluation-set column) are
    carried through and become part of the query key.

    The (qid, term) table is broadcast when its counted bytes are at most
    ``broadcast_bytes``: the postings then stay where they are. Beyond
    the bound, or with ``broadcast_bytes=None``, the planner's own choice
    applies (a shuffle join on ``term``, hot terms split by AQE's skew join).
    """
    _check(mode, k)
    keys = list(extra_keys or [])
    qt = bounded_broadcast(_batch_terms(queries, id_col, text_col, keys), broadcast_bytes)
    return _ranked(score(postings, qt), k, mode, keys, id_col)


def bm25_search_counts(tf: DataFrame, dfreq: DataFrame | None, stats: DataFrame, queries: DataFrame,
                       k: int = 1000, mode: str = "or", id_col: str = "qid",
                       text_col: str = "text", extra_keys: list[str] | None = None,
                       broadcast_bytes: int | None = BROADCAST_BYTES,
                       k1: float = T.BM25_K1, b: float = T.BM25_B,
                       term_buckets: int | None = None, packed: DataFrame | None = None,
                       known: dict[str, int] | None = None) -> DataFrame:
    """Same run as ``bm25_search``, over per-document term counts.

    ``tf`` (term, doc_id, doc_len, tf[, term_bucket]), ``dfreq`` (term, df),
    ``stats`` (n_docs, avg_len). The batch's terms pick up their ``df`` (a
    lookup of the query terms only; counted in ``tf`` without ``dfreq``), and only the matched rows are weighted,
    with the expression the index build uses (identical impacts).

    With a document-bucketed ``tf`` the per-document sum and a per-bucket
    top-k run without any shuffle. ``term_buckets``: ``tf`` carries a
    ``term_bucket`` partition column; the join also matches on it, so
    dynamic partition pruning reads only the buckets of the batch's terms.
    ``packed``: the same counts with one row for each document, no id twice;
    a batch of bounded size is then looked up and summed inside these rows.
    ``known``: see ``term_weights``.
    """
    _check(mode, k)
    keys = list(extra_keys or [])
    qt = _batch_terms(queries, id_col, text_col, keys)
    join_keys = ["term"]
    if term_buckets:
        qt = qt.withColumn("term_bucket", T.term_bucket("term", term_buckets))
        join_keys = ["term_bucket", "term"]
    # one count of bytes decides all broadcasts: the df lookup drops rows and adds a number
    hinted = bounded_broadcast(qt, broadcast_bytes)
    small = hinted is not qt
    if small and dfreq is None and dict(tf.dtypes)["doc_id"] == "bigint":     # a lexicon prunes the scan by the aggregate's plan
        numbered = _numbered(qt, min(broadcast_bytes, BLOCK_QUERY_BYTES))
        if numbered is not None and packed is not None:
            return _ranked(_packed_scores(packed, stats, numbered, k, mode, k1, b, known), k, mode, keys, id_col)
        if numbered is not None:
            return _ranked(_block_scores(tf, dfreq, stats, numbered, join_keys, k, mode, k1, b), k, mode, keys, id_col)
    # df of the batch's terms only; out-of-lexicon terms drop out here (a
    # lexicon partitioned by term bucket is pruned to the batch's buckets)
    if dfreq is None:
        asked = bounded_broadcast(qt.select(*join_keys).distinct(), broadcast_bytes)
        dfreq = tf.select(*join_keys).join(asked, join_keys).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    lex_keys = join_keys if "term_bucket" in dfreq.columns else ["term"]
    qt = dfreq.select(*lex_keys, "df").join(hinted, lex_keys)
    if small:
        qt = F.broadcast(qt)
    matched = tf.select(*join_keys, "doc_id", "doc_len", "tf").join(qt, join_keys)
    weighted = _weigh(matched, stats, k1, b)
    scored = (weighted.groupBy("qid", "doc_id", "n_terms")
              .agg(F.sum("impact_q").cast("bigint").alias("score_q"),
                   F.count(F.lit(1)).cast("bigint").alias("n_matched")))
    return _ranked(scored, k, mode, keys, id_col)


def _numbered(qt: DataFrame, max_bytes: int, by: tuple[str, ...] = ("qid", "n_terms")) -> DataFrame | None:
    """``qt`` with dense numbers q of (qid, n_terms) and t of the terms, from 0; None beyond ``max_bytes``."""
    if bounded_broadcast(qt, max_bytes) is qt:
        return None
    q = F.dense_rank().over(Window.orderBy(*by)) - 1      # bounded rows: one task
    t = F.dense_rank().over(Window.orderBy("term")) - 1
    return materialize(qt.withColumn("q", q).withColumn("t", t), "query-terms")


def _block_scores(tf: DataFrame, dfreq: DataFrame | None, stats: DataFrame, numbered: DataFrame, join_keys: list[str],
                  k: int, mode: str, k1: float, b: float) -> DataFrame:
    """(qid, n_terms, doc_id, score_q, n_matched) of each task's k best documents for each query, at least."""
    terms = F.broadcast(numbered.select(*join_keys, "t").distinct())
    if dfreq is None:
        dfreq = tf.select(*join_keys).join(terms, join_keys).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    lex_keys = join_keys if "term_bucket" in dfreq.columns else ["term"]
    lookup = F.broadcast(dfreq.select(*lex_keys, "df").join(terms, lex_keys).select(*join_keys, "t", "df"))
    weighted = _weigh(tf.select(*join_keys, "doc_id", "doc_len", "tf").join(lookup, join_keys), stats, k1, b)
    # summed by term first: the list of an id that very many rows share stays within the batch's terms
    by_doc = weighted.groupBy("doc_id", "t").agg(F.sum("impact_q").cast("bigint").alias("s"), F.count(F.lit(1)).alias("n")) \
        .groupBy("doc_id").agg(F.collect_list(F.struct("t", "s", "n")).alias("held"))
    pairs = numbered.select("q", "t", "n_terms").toPandas().sort_values("t")       # numbers of a bounded batch
    if pairs.empty:
        return _no_scores(numbered)
    asks = _Asks(pairs, k, mode)

    def blocks(whole: pa.RecordBatch):
        for at in range(0, whole.num_rows, asks.rows):
            block = whole.slice(at, asks.rows)
            held = block.column(1)
            flat = held.flatten()
            t, s, n = (flat.field(i).to_numpy(zero_copy_only=False) for i in range(3))
            yield block.column(0), PK.document_of(held), t, s, n

    return _named(map_bounded(by_doc, asks.kernel(blocks), HITS), numbered)


def _named(hits: DataFrame, numbered: DataFrame) -> DataFrame:
    return hits.join(F.broadcast(numbered.select("q", "qid", "n_terms").distinct()), "q").drop("q")


def _packed_scores(packed: DataFrame, stats: DataFrame, numbered: DataFrame, k: int, mode: str, k1: float, b: float,
                   known: dict[str, int] | None = None) -> DataFrame:
    """As ``_block_scores``, from rows of whole documents: the batch's terms are looked up in each Arrow batch."""
    pairs = numbered.select("q", "t", "n_terms", "term").toPandas().sort_values("t")       # a bounded batch
    if pairs.empty:
        return _no_scores(numbered)
    wanted = pa.array(pairs.drop_duplicates("t")["term"], pa.string())
    idf, avg_len = term_weights(packed, stats, wanted, known)
    asks = _Asks(pairs, k, mode)

    def blocks(whole: pa.RecordBatch):
        doc, t, s = weighed(whole, wanted, idf, avg_len, k1, b)
        for at, to, some in asks.parts(whole.num_rows, doc, t):
            yield whole.column(0).slice(at, to - at), doc[some] - at, t[some], s[some], 1

    return _named(map_bounded(packed.select("doc_id", "doc_len", "terms", "tfs"), asks.kernel(blocks), HITS), numbered)


def term_weights(packed: DataFrame, stats: DataFrame, wanted: pa.Array,
                 known: dict[str, int] | None = None) -> tuple[np.ndarray, float | None]:
    """The idf of each wanted term (0 for one that no document holds) and the mean length.

    ``known``: document frequencies counted before over the same rows; those of another batch are counted and take their place.
    """
    one, terms, known = stats.first(), wanted.to_pylist(), {} if known is None else known
    if not known.keys() >= set(terms):
        counted = PK.term_counts(packed, wanted).toPandas()
        known.clear()
        known.update(dict.fromkeys(terms, 0) | {terms[t]: int(n) for t, n in zip(counted["t"], counted["df"])})
    held = stats.sparkSession.createDataFrame([(t, known[w]) for t, w in enumerate(terms) if known[w]], "t int, df bigint")
    weights = held.select("t", T.idf(F.lit(one["n_docs"]), "df").alias("w")).toPandas()
    idf = np.zeros(len(wanted))
    idf[weights["t"].to_numpy(np.int64)] = weights["w"]
    return idf, one["avg_len"]


def weighed(whole: pa.RecordBatch, wanted: pa.Array, idf: np.ndarray, avg_len: float | None, k1: float,
            b: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, term number, quantised weight) of the wanted postings in packed rows, by row."""
    doc, at, t = PK.found(whole.column(2), wanted)
    tf = PK.counts_at(whole.column(3), at).to_numpy(zero_copy_only=False)
    length = whole.column(1).to_numpy(zero_copy_only=False)[doc]
    return doc, t, PK.impacts(idf[t], tf, length, avg_len, k1, b, T.IMPACT_MAX, T.IMPACT_LEVELS)


HITS = "q int, doc_id bigint, score_q bigint, n_matched bigint"


def _no_scores(numbered: DataFrame) -> DataFrame:
    return numbered.select("qid", "n_terms", *(F.lit(0).cast("bigint").alias(c) for c in ("doc_id", "score_q", "n_matched")))


class _Asks:
    """Which queries ask for which terms; sums of blocks of documents, and each task's k best of a query."""

    def __init__(self, pairs, k: int, mode: str, n_queries: int = 0, n_terms: int = 0):
        self.k, self.mode = k, mode
        self.asks = pairs["q"].to_numpy()                  # by term
        self.n_queries = n_queries or int(self.asks.max()) + 1
        self.fan = np.bincount(pairs["t"], minlength=n_terms)
        self.begin = np.cumsum(self.fan) - self.fan
        self.needed = np.zeros(self.n_queries, np.int64)
        self.needed[self.asks] = pairs["n_terms"]
        self.rows = max(1, BLOCK_CELLS // self.n_queries)
        self.kept_rows, self.block_pairs = KEPT_ROWS, BLOCK_PAIRS

    def parts(self, n: int, doc: np.ndarray, t: np.ndarray, fan: np.ndarray | None = None):
        """(first row, end, slice of postings) of blocks of bounded cells and pairs; ``doc`` ascends."""
        ends = np.cumsum(np.bincount(doc, (self.fan if fan is None else fan)[t], n))
        at = 0
        while at < n:
            before = ends[at - 1] if at else 0
            to = min(at + self.rows, n, max(at + 1, int(np.searchsorted(ends, before + self.block_pairs, "right"))))
            yield at, to, slice(*np.searchsorted(doc, (at, to)))
            at = to

    def spread(self, doc: np.ndarray, t: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(cell, times): the (document, query) cells that each posting adds to, and their number by posting."""
        times = self.fan[t]
        start = np.cumsum(times) - times
        ask = self.asks[np.arange(int(times.sum())) + np.repeat(self.begin[t] - start, times)]
        return ask + np.repeat(doc * self.n_queries, times), times

    def sums(self, n: int, doc: np.ndarray, t: np.ndarray, s: np.ndarray, match) -> tuple[np.ndarray, ...]:
        """(query, row, score, matches) of the candidates of a block of n documents."""
        cell, times = self.spread(doc, t)
        score = np.bincount(cell, np.repeat(s, times), n * self.n_queries)
        match = np.bincount(cell, None if np.ndim(match) == 0 else np.repeat(match, times), n * self.n_queries)
        some = np.flatnonzero(match == np.tile(self.needed, n) if self.mode == "and" else match)
        return some % self.n_queries, some // self.n_queries, score[some].astype(np.int64), match[some].astype(np.int64)

    def best(self, some: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
        """The k first rows of each query in the order of the run, and each query's score at k (-1: fewer)."""
        width = int(some[3].max(initial=0)) + 1
        if self.n_queries * width <= SCORE_CELLS:
            held = np.bincount(some[0] * width + some[3], minlength=self.n_queries * width).reshape(-1, width)
            reach = np.cumsum(held[:, ::-1], axis=1) >= self.k           # by falling score
            bar = np.where(reach[:, -1], width - 1 - reach.argmax(axis=1), 0)
            able = some[3] >= bar[some[0]]                               # ties at the bar are sorted by id
            some = [c[able] for c in some]
        key = some[0] * (int(some[3].max(initial=0)) + 1) - some[3]      # by query, then falling score
        order = np.lexsort((some[1], key) if some[2].all() else (some[1], some[2], key))       # null ids first
        some = [c[order] for c in some]
        size = np.bincount(some[0], minlength=self.n_queries)
        place = np.arange(len(order)) - np.repeat(np.cumsum(size) - size, size)
        least = np.full(self.n_queries, -1)
        last = place == self.k - 1
        least[some[0][last]] = some[3][last]
        return [c[place < self.k] for c in some], least

    @staticmethod
    def batch(some: list[np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(some[0].astype(np.int32)), pa.array(some[1], pa.int64(), mask=~some[2]),
                                           pa.array(some[3]), pa.array(some[4])], names=["q", "doc_id", "score_q", "n_matched"])

    def kernel(self, blocks, sums=None, bars: np.ndarray | None = None):
        """The function for ``mapInArrow``: ``blocks(batch)`` gives (ids, row, term, weight, count) of blocks of documents.

        ``bars``: scores of the queries below which no document is asked for.
        """
        sums = sums or (lambda column, *held: self.sums(len(column), *held))

        def run(batches):
            kept, fresh, least = None, [], np.full(self.n_queries, -1) if bars is None else bars
            for whole in batches:
                for column, *held in blocks(whole):
                    q, place, score, match = sums(column, *held)
                    able = score >= least[q]
                    q, place = q[able], place[able]
                    known = column.is_valid().to_numpy(zero_copy_only=False)
                    ids = column.fill_null(0).to_numpy(zero_copy_only=False)
                    some = [q, ids[place], known[place], score[able], match[able]]
                    if self.k * self.n_queries > self.kept_rows:
                        yield self.batch(self.best(some)[0])
                        continue
                    fresh.append(some)
                    if sum(len(f[0]) for f in fresh) > self.kept_rows // 2:
                        kept, least = self.best([np.concatenate(c) for c in zip(*([kept] if kept else []), *fresh)])
                        least = least if bars is None else np.maximum(least, bars)
                        fresh = []
            if fresh or kept:
                yield self.batch(self.best([np.concatenate(c) for c in zip(*([kept] if kept else []), *fresh)])[0])

        return run


def _weigh(matched: DataFrame, stats: DataFrame, k1: float, b: float) -> DataFrame:
    """Add impact_q to matched (.., tf, df, doc_len) rows: the BM25 weight and
    quantiser of ``index.with_impacts``, from the same column expressions."""
    both = stats.select(F.struct("n_docs", "avg_len").alias("s")).scalar()  # one subquery
    impact = T.bm25_impact("tf", "df", "doc_len", both["n_docs"], both["avg_len"], k1, b)
    return matched.withColumn("impact_q", T.quantize(impact))
