"""The passages that have a vector are filtered where they are read, and written once for the index."""

from quarry.operators import index as IX
from quarry.plans import systems as PL


def _tables(spark, at):
    docs = [(i, f"w{i} text") for i in range(20)] + [(3, "again"), (None, "no id"), (25, None)]
    spark.createDataFrame(docs, "doc_id bigint, text string").write.parquet(f"{at}/documents.parquet")
    vectors = [(i, [1.0]) for i in (3, 3, 7, None, 25, 99)]
    spark.createDataFrame(vectors, "vec_id bigint, embedding array<float>").write.parquet(f"{at}/embeddings.parquet")
    spark.createDataFrame([(1, "w3 w7 again"), (2, "text")], "item_id bigint, text string").write.parquet(f"{at}/benchmark.parquet")


def test_no_text_is_shuffled_to_its_vector(spark, tmp_path):
    _tables(spark, tmp_path)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        some = PL.subset_passages(spark, str(tmp_path))
        assert "BroadcastHashJoin" in some._jdf.queryExecution().executedPlan().toString()
        want = [(3, "again"), (3, "w3 text"), (7, "w7 text"), (25, None)]
        assert sorted(map(tuple, some.collect()), key=repr) == sorted(want, key=repr)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_the_keyword_run_indexes_a_written_copy(spark, tmp_path, monkeypatch):
    _tables(spark, tmp_path)
    plans, real = [], IX.TextIndex.build.__func__
    monkeypatch.setattr(IX.TextIndex, "build", classmethod(
        lambda cls, docs, *a, **kw: plans.append(docs._jdf.queryExecution().optimizedPlan().toString()) or real(cls, docs, *a, **kw)))
    judged = spark.createDataFrame([("dev", 1, 3, 1), ("dev", 2, 3, 1)], "eval_set string, qid bigint, pid bigint, rel int")
    run = PL.bm25_run(spark, str(tmp_path), judged, 10)
    assert len(plans) == 1 and "Join" not in plans[0]
    assert {(r["qid"], r["pid"]) for r in run.collect()} == {(1, 3), (1, 7), (2, 3), (2, 7)}
