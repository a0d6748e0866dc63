"""Sums in blocks of documents against the aggregate over (query, document)."""

import pytest
from pyspark.sql import functions as F

from quarry.operators import bounded as BD
from quarry.operators import index as IX
from quarry.operators import search as S


@pytest.fixture(scope="module")
def odd(spark):
    words = [f"w{i % 7} w{i % 3} common{' rare' * (i % 5 == 0)}" for i in range(300)]
    rows = [(i, w) for i, w in enumerate(words)] + [(3, words[3]), (None, "w1 w2"), (None, "w1"), (900, None), (901, "é -")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    queries = spark.createDataFrame([(1, "w1 common"), (2, "rare w2 gone"), (2, "rare"), (2, "rare"), (None, "common"),
                                     (4, None), (5, "gone"), (6, "rare w0")], "qid bigint, text string")
    return docs, queries


def _sorted(run):
    return sorted(map(tuple, run.select("qid", "pid", "rank", "score", "score_q").collect()), key=repr)


@pytest.mark.parametrize("mode", ["or", "and"])
@pytest.mark.parametrize("limits", [(S.BLOCK_CELLS, S.KEPT_ROWS), (20, 100), (20, 10)])
def test_same_run_as_the_aggregate(odd, monkeypatch, mode, limits):
    docs, queries = odd
    monkeypatch.setattr(S, "BLOCK_CELLS", limits[0])
    monkeypatch.setattr(S, "KEPT_ROWS", limits[1])
    idx = IX.TextIndex.build(docs, n_buckets=3)
    for k in (5, 1000):
        assert _sorted(idx.search(queries, k=k, mode=mode)) == _sorted(idx.search(queries, k=k, mode=mode, broadcast_bytes=0))


def test_a_search_weighs_postings_once_and_keeps_its_best_in_tasks(odd):
    docs, queries = odd
    plan = IX.TextIndex.build(docs).search(queries, k=5)._jdf.queryExecution().toString()
    assert "MapInArrow" in plan and "qid#" not in plan.split("MapInArrow")[-1].split("HashAggregate")[0]


def test_buckets_follow_the_bytes(spark, monkeypatch):
    docs = spark.range(64).select(F.col("id").alias("doc_id"), F.repeat(F.lit("word "), 100).alias("text"))
    monkeypatch.setattr(IX, "BUCKET_BYTES", 500)
    assert IX.TextIndex.build(docs).params["n_buckets"] >= 64


def test_terms_are_ascii_letters_and_digits(spark):
    docs = spark.createDataFrame([(1, "A-b1 é A٠_A"), (2, None), (3, "")], "doc_id bigint, text string")
    assert sorted(map(tuple, IX.term_freq(docs, keep_len=True).collect())) == [("A", 1, 4, 3), ("b1", 1, 4, 1)]


def test_bounds_are_the_largest_impacts(odd):
    docs, _ = odd
    index = IX.TextIndex.build(docs)
    got = BD.BoundedIndex.build(index, n_blocks=4).bounds.select("term", "block", "most", "df").collect()
    want = index.postings.groupBy("term", BD.doc_block(4).alias("block")).agg(F.max("impact_q"), F.first("df")).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))
