"""Joins without room for a broadcast, queries without inner tokens, and the shared scratch folder."""

import pytest
from pyspark.sql import functions as F

from quarry import session
from quarry.operators import index as IX
from quarry.operators import rerank as RR
from quarry.plans import judgments as J
from quarry.sources import tables as TB


@pytest.fixture
def no_auto_broadcast(spark):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for k in keys:
        spark.conf.set(k, "-1")
    yield
    for k in keys:
        spark.conf.unset(k)


def plan_of(df):
    return df._jdf.queryExecution().toString()


def test_no_broadcast_without_room(spark, sf_small, no_auto_broadcast):
    queries, vecs = TB.keyword_queries(spark, sf_small), TB.vectors(spark, sf_small)
    docs = TB.passages(spark, sf_small).join(vecs.select(F.col("id").alias("doc_id")), "doc_id", "left_semi")
    idx = IX.TextIndex.build(docs)
    run = idx.search(queries, k=20, broadcast_bytes=0)
    assert "BroadcastHashJoin" not in plan_of(run) and "BroadcastNestedLoop" not in plan_of(run)
    qv = vecs.select(F.col("id").alias("qid"), "embedding")
    out = RR.rerank(run, qv, vecs, 10, broadcast_bytes=0)
    assert "Broadcast" not in plan_of(out).replace("autoBroadcast", "")
    contain = J.containment_qrels(TB.passages(spark, sf_small), queries, broadcast_bytes=0)
    assert "BroadcastHashJoin" not in plan_of(contain) and "NestedLoop" not in plan_of(contain)
    assert sorted(map(tuple, run.select("qid", "pid", "rank").collect())) == \
        sorted(map(tuple, idx.search(queries, k=20).select("qid", "pid", "rank").collect()))


def test_bounded_broadcast_counts_bytes(spark):
    df = spark.createDataFrame([(1, "x" * 1000), (2, None)], "id bigint, text string")
    assert session.bounded_broadcast(df, 2000) is not df
    assert session.bounded_broadcast(df, 900) is df
    assert session.bounded_broadcast(df, None) is df


def test_containment_of_queries_without_inner_tokens(spark):
    docs = spark.createDataFrame([(1, "alpha beta gamma"), (2, "xx-yy zz"), (3, "a"), (4, None), (5, "ALPHA beta, alpha")],
                                 "doc_id bigint, text string")
    texts = ["alpha", "a", "beta gamma", "-", "xx-yy zz", "", "alpha beta gamma", "nothing", "l", " beta", None]
    queries = spark.createDataFrame(list(enumerate(texts)), "qid bigint, text string")
    got = sorted((r["qid"], r["pid"]) for r in J.containment_qrels(docs, queries).collect())
    want = sorted((q, d) for q, t in enumerate(texts) if t is not None
                  for d, text in [(1, "alpha beta gamma"), (2, "xx-yy zz"), (3, "a"), (5, "ALPHA beta, alpha")] if t in text)
    assert got == want


def test_a_cluster_needs_a_shared_folder(monkeypatch):
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return self

        def get(self, *_):
            return None

    class Session:
        sparkContext = Context()
        conf = Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session())
