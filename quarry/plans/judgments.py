"""Relevance judgments derived from the tables (the test collections ship none).

* containment: a passage is relevant (grade 1) to a query whose whole text it
  contains verbatim;
* graded: containment pairs get grade 2 + quality; the other labelled
  passages in the top ``pool_depth`` of a run (depth-k pooling, as in shared
  evaluation campaigns) get their quality (0 or 1) as grade.

Containment is an exact substring test on whole texts. Candidates come from
an equi-join on an *anchor*. A token strictly inside the query (not its first
or last) is bounded by separators inside the query text, so it is a whole
token of every passage containing the query; of these, the one in the fewest
passages is taken: document frequencies come first, and only the chosen
tokens' passages are matched. Both come from a text index of the passages if
there is one. The candidate pairs, ids only, are written once; their text is
fetched by a join that broadcasts them if their bytes allow. A bounded list of
queries without such a token is tested inside each passage's row; more of them
are anchored on the character n-gram they begin with (``GRAM`` characters, or
all of a shorter query). The plan has equi-joins only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions import text as T
from quarry.operators.index import TextIndex
from quarry.session import BROADCAST_BYTES, bounded_broadcast, materialize


GRAM = 8   # characters of the n-gram that anchors a query without inner tokens


def _token_candidates(docs: DataFrame, q: DataFrame, index: TextIndex | None) -> DataFrame:
    """(qid, doc_id) of passages with the rarest inner token of the query; ``q(qid, inner)``."""
    inner = q.select("qid", F.explode("inner").alias("term"))
    if index is not None:
        df = index.frequencies(inner)
    else:
        # explode_outer + filter: a plain explode would make Catalyst re-run the regex
        doc_terms = (docs.select("doc_id", F.explode_outer(F.array_distinct(T.tokens("text"))).alias("term"))
                     .where(F.col("term").isNotNull()))
        wanted = bounded_broadcast(inner.select("term").distinct())
        df = doc_terms.join(wanted, "term").groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    # a token that no passage has rules its query out
    rarest = materialize(inner.join(df, "term", "left").groupBy("qid").agg(
        F.min(F.struct(F.coalesce("df", F.lit(0)).alias("df"), F.col("term"))).alias("a")).where("a.df > 0")
        .select("qid", F.col("a.term").alias("term")), "anchor-tokens")
    doc_terms = index.postings_of(rarest).select("doc_id", "term") if index is not None else doc_terms
    return doc_terms.join(bounded_broadcast(rarest), "term").select("qid", "doc_id")


SHORT_BYTES = 1 << 16      # of short queries that are tested inside each passage's row


def _short_hits(docs: DataFrame, q: DataFrame) -> DataFrame | None:
    """(qid, pid) of the short queries ``q(qid, qtext)`` that passages contain; None beyond the bound."""
    size = q.agg(F.sum(F.octet_length("qtext") + 8)).first()[0] or 0
    if size > SHORT_BYTES:
        return None
    rows = q.collect()
    if not rows:
        return docs.where(F.lit(False)).select(F.lit(None).cast(q.schema["qid"].dataType).alias("qid"),
                                               F.col("doc_id").alias("pid"))
    some = F.array(*[F.struct(F.lit(r["qid"]).alias("qid"), F.lit(r["qtext"]).alias("qtext")) for r in rows])
    held = F.filter(some, lambda x: F.contains(F.col("text"), x["qtext"]))
    return docs.where("text is not null").select(F.explode(F.transform(held, lambda x: x["qid"])).alias("qid"),
                                                 F.col("doc_id").alias("pid"))


def _gram_candidates(docs: DataFrame, q: DataFrame) -> DataFrame:
    """(qid, doc_id) of passages with the query's first n-gram; ``q(qid, qtext)``, no query empty."""
    q = q.select("qid", F.substring("qtext", 1, GRAM).alias("gram")).withColumn("n", F.length("gram"))
    sizes = sorted(r["n"] for r in q.select("n").distinct().collect())     # at most GRAM numbers
    grams = None
    for n in sizes:
        starts = F.sequence(F.lit(1), F.greatest(F.length("text") - n + 1, F.lit(1)))
        at = docs.where(F.length("text") >= n).select("doc_id", F.explode(F.array_distinct(
            F.transform(starts, lambda i: F.substring("text", i, n)))).alias("gram"))  # noqa: B023
        grams = at if grams is None else grams.unionByName(at)
    return grams.join(q, "gram").select("qid", "doc_id").distinct()


def containment_qrels(docs: DataFrame, queries: DataFrame, broadcast_bytes: int | None = BROADCAST_BYTES,
                      index: TextIndex | None = None) -> DataFrame:
    """(qid, pid, rel=1) for every passage containing the query text verbatim.

    An empty query is contained in every passage that has a text; a null query in none.
    """
    q = materialize(queries.select("qid", F.col("text").alias("qtext"), T.tokens("text").alias("qt")).where("qtext is not null")
                    .select("qid", "qtext", F.slice("qt", 2, F.greatest(F.size("qt") - 2, F.lit(0))).alias("inner")),
                    "containment-queries")
    short = q.where(F.size("inner") == 0)
    hits = _short_hits(docs, short.select("qid", "qtext"))
    cand = _token_candidates(docs, q.where(F.size("inner") > 0), index)
    if hits is None:
        cand = cand.unionByName(_gram_candidates(docs, short.where("qtext <> ''")))
        blank = short.where("qtext = ''").select("qid", F.lit(True).alias("all"))
        hits = docs.where("text is not null").select(F.col("doc_id").alias("pid"), F.lit(True).alias("all")) \
            .join(bounded_broadcast(blank, broadcast_bytes), "all").select("qid", "pid")
    cand = bounded_broadcast(materialize(cand, "containment-candidates"), broadcast_bytes)
    qtext = bounded_broadcast(q.select("qid", "qtext"), broadcast_bytes)
    inside = (docs.select("doc_id", "text").join(cand, "doc_id").join(qtext, "qid")
              .where(F.col("text").contains(F.col("qtext"))).select("qid", F.col("doc_id").alias("pid")))
    return inside.unionByName(hits).select("qid", "pid", F.lit(1).alias("rel"))


def graded_qrels(contain: DataFrame, pool_run: DataFrame, labels: DataFrame,
                 pool_depth: int) -> DataFrame:
    """(qid, pid, rel): containment pairs 2 + quality; other pooled labelled passages quality."""
    lab = labels.select(F.col("doc_id").alias("pid"), "quality")
    top = (contain.select("qid", "pid").join(lab, "pid", "left")
           .select("qid", "pid", (F.lit(2) + F.coalesce(F.col("quality"), F.lit(0))).alias("rel")))
    pooled = (pool_run.where(F.col("rank") <= F.lit(pool_depth)).select("qid", "pid")
              .join(contain.select("qid", "pid"), ["qid", "pid"], "left_anti")
              .join(lab, "pid")
              .select("qid", "pid", F.col("quality").alias("rel")))
    return top.unionByName(pooled)
