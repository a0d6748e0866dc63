"""Scratch indexes of one row for each document against the postings of one row for each term."""

import pytest
from pyspark.sql import functions as F

from quarry.operators import bounded as BD
from quarry.operators import index as IX
from quarry.operators import search as S
from quarry.plans import judgments as J

DOCS = [(i, " ".join(f"w{i % n}" for n in range(2, 40)) + " x" * (i % 9)) for i in range(300)] \
    + [(300, None), (301, ""), (302, "é ٠ -"), (None, "w1 x lone")]
QUERIES = [(1, "w1 w2 x"), (2, "lone gone"), (3, "gone"), (None, "w3 w30 w7"), (5, "w1 x"), (6, None)]


@pytest.fixture(scope="module")
def tables(spark):
    return spark.createDataFrame(DOCS, "doc_id bigint, text string"), spark.createDataFrame(QUERIES, "qid bigint, text string")


def rows(df, *cols):
    return sorted(map(tuple, df.select(*cols).collect()), key=repr)


RUN = ("qid", "pid", "rank", "score", "score_q")


def test_one_row_for_each_document_holds_all_postings(tables):
    docs, _ = tables
    index = IX.TextIndex.build(docs, n_buckets=3)
    assert index.packed.count() == docs.count()
    cols = ("term", "doc_id", "doc_len", "tf")
    assert rows(index.tf, *cols) == rows(IX.term_freq(docs, keep_len=True), *cols)


@pytest.mark.parametrize("mode", ["or", "and"])
@pytest.mark.parametrize("limits", [(S.BLOCK_PAIRS, S.KEPT_ROWS), (7, 100), (7, 10)])
def test_lookups_give_the_run_of_the_aggregate(tables, monkeypatch, mode, limits):
    docs, queries = tables
    monkeypatch.setattr(S, "BLOCK_PAIRS", limits[0])
    monkeypatch.setattr(S, "KEPT_ROWS", limits[1])
    index = IX.TextIndex.build(docs, n_buckets=3)
    for k in (4, 1000):
        assert rows(index.search(queries, k=k, mode=mode), *RUN) == \
            rows(S.bm25_search(IX.build_postings(docs), queries, k=k, mode=mode), *RUN)


def test_ids_that_repeat_are_summed_by_the_aggregate(tables):
    docs, queries = tables
    twice = docs.unionByName(docs.where("doc_id is null or doc_id < 20"))
    index = IX.TextIndex.build(twice, n_buckets=3)
    assert index.packed is None
    assert rows(index.search(queries, k=9), *RUN) == rows(S.bm25_search(IX.build_postings(twice), queries, k=9), *RUN)


def test_a_few_terms_are_found_without_a_pass_over_postings(tables):
    docs, queries = tables
    index = IX.TextIndex.build(docs, n_buckets=3)
    asked = queries.limit(0).select(F.lit("").alias("term")).union(
        queries.sparkSession.createDataFrame([("lone",), ("x",), ("x",), ("gone",), (None,)], "term string"))
    for found in (index.frequencies(asked), index.postings_of(asked)):
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "Generate" not in plan and "MapInArrow" in plan
    assert rows(index.frequencies(asked), "term", "df") == \
        rows(IX.doc_freq(index.tf).where("term in ('lone', 'x')"), "term", "df")
    cols = ("term", "doc_id", "doc_len", "tf")
    assert rows(index.postings_of(asked), *cols) == rows(index.tf.where("term in ('lone', 'x')"), *cols)


def test_containment_is_the_same_with_an_index(spark, tables):
    docs, _ = tables
    texts = spark.createDataFrame([(1, "w0 w0 w0 w0"), (2, "w1 w1"), (3, "x x x"), (4, "a gone z"), (5, ""), (6, None)], "qid bigint, text string")
    index = IX.TextIndex.build(docs, n_buckets=3)
    assert rows(J.containment_qrels(docs, texts, index=index), "qid", "pid", "rel") == rows(J.containment_qrels(docs, texts), "qid", "pid", "rel")


@pytest.mark.parametrize("k", [1, 4, 1000])
def test_bounded_search_sums_inside_documents(tables, k):
    docs, queries = tables
    some = queries.unionByName(queries.where("qid = 1")).unionByName(queries.limit(0).union(
        queries.sparkSession.createDataFrame([(7, "w2 w3 w38 w37 x"), (7, "w2 w3 w38 w37 x")], "qid bigint, text string")))
    index = IX.TextIndex.build(docs, n_buckets=3)
    bounded = BD.BoundedIndex.build(index, n_blocks=8)
    run = bounded.search(some, k=k)
    assert "Generate" not in run._jdf.queryExecution().toString()
    for rare in (BD.RARE, 0.01):
        assert rows(bounded.search(some, k=k, rare=rare), *RUN) == rows(S.bm25_search(IX.build_postings(docs), some, k=k), *RUN)


def test_bounds_of_packed_documents_are_those_of_postings(tables):
    docs, _ = tables
    index = IX.TextIndex.build(docs, n_buckets=3)
    want = index.postings.groupBy("term", BD.doc_block(8).alias("block")).agg(F.max("impact_q").alias("most"), F.first("df").alias("df"))
    assert rows(BD.BoundedIndex.build(index, n_blocks=8).bounds, "term", "block", "most", "df") == rows(want, "term", "block", "most", "df")


def test_bounded_search_for_terms_that_no_document_holds(tables):
    docs, queries = tables
    bounded = BD.BoundedIndex.build(IX.TextIndex.build(docs, n_buckets=3), n_blocks=8)
    assert bounded.search(queries.where("qid = 3"), k=5).count() == 0
