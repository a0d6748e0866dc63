import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.operators import ann as AN
from quarry.operators import knn as KN
from quarry.operators import rerank as RR
from quarry.sources import tables as TB


def vec_df(spark, rows, idname="id"):
    return spark.createDataFrame(rows, f"{idname} bigint, embedding array<float>")


def test_knn_matches_brute_force(spark, sf_small):
    vecs = TB.vectors(spark, sf_small)
    queries = vecs.where("id < 7").select(F.col("id").alias("qid"), "embedding")
    # small blocks force a multi-cell grid
    run = KN.knn_exact(vecs, queries, 5, p_block_rows=64, q_block_rows=3)
    pdf = vecs.toPandas()
    mat = np.stack(pdf["embedding"].map(lambda v: np.asarray(v, np.float64)))
    ids = pdf["id"].to_numpy()
    got = {}
    for r in run.collect():
        got.setdefault(r["qid"], []).append((r["rank"], r["pid"]))
    for qi in range(7):
        s = mat @ mat[list(ids).index(qi)]
        order = sorted(range(len(ids)), key=lambda j: (-s[j], ids[j]))[:5]
        assert [p for _, p in sorted(got[qi])] == [int(ids[j]) for j in order]


def test_few_vectors_return_fewer_rows(spark):
    p = vec_df(spark, [(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [1.0, 1.0])])
    q = vec_df(spark, [(10, [1.0, 0.5])], "qid")
    assert KN.knn_exact(p, q, 10).count() == 3
    idx = AN.VectorIndex.build(p, 2)
    assert idx.search(q, 10, nprobe=2).count() == 3


def test_ann_full_probe_equals_exact(spark, sf_small):
    vecs = TB.vectors(spark, sf_small)
    queries = vecs.where("id % 50 = 0").select(F.col("id").alias("qid"), "embedding")
    exact = KN.knn_exact(vecs, queries, 10).select("qid", "pid", "rank")
    idx = AN.VectorIndex.build(vecs, 8)
    approx = idx.search(queries, 10, nprobe=8).select("qid", "pid", "rank")
    assert exact.exceptAll(approx).count() == 0 and approx.exceptAll(exact).count() == 0


def test_ann_multi_assignment_dedupes(spark, sf_small):
    vecs = TB.vectors(spark, sf_small)
    queries = vecs.where("id < 5").select(F.col("id").alias("qid"), "embedding")
    idx = AN.VectorIndex.build(vecs, 8, assign_k=3)
    run = idx.search(queries, 10, nprobe=8)
    assert run.groupBy("qid", "pid").count().where("count > 1").count() == 0
    st = idx.stats().first()
    assert st["n_entries"] == 3 * st["n_vectors"]


def test_kmeans_index_builds(spark, sf_small):
    vecs = TB.vectors(spark, sf_small)
    idx = AN.VectorIndex.build(vecs, 4, train="kmeans", iters=3)
    assert idx.centroids.count() == 4
    assert idx.assignment.count() == vecs.count()


def test_rerank_ties_keep_original_order(spark):
    run = spark.createDataFrame([(1, 7, 1), (1, 8, 2), (1, 9, 3)], "qid bigint, pid bigint, rank bigint")
    qv = vec_df(spark, [(1, [1.0, 0.0])], "qid")
    pv = vec_df(spark, [(7, [0.0, 1.0]), (8, [1.0, 0.0]), (9, [2.0, 0.0])])
    out = sorted((r["rank"], r["pid"]) for r in RR.rerank(run, qv, pv, 3).collect())
    assert out == [(1, 8), (2, 9), (3, 7)]


def test_rerank_is_permutation_of_head(spark, sf_small):
    from quarry.plans import catalog as C
    run = C._subset_run(spark, sf_small, k=20)
    out = RR.rerank(run, C._query_vectors(spark, sf_small), TB.vectors(spark, sf_small), 10)
    head = run.where("rank <= 10").select("qid", "pid")
    assert out.select("qid", "pid").exceptAll(head).count() == 0
    assert head.exceptAll(out.select("qid", "pid")).count() == 0


def test_zero_vector_rerank_score(spark):
    run = spark.createDataFrame([(1, 7, 1)], "qid bigint, pid bigint, rank bigint")
    qv = vec_df(spark, [(1, [1.0, 0.0])], "qid")
    pv = vec_df(spark, [(7, [0.0, 0.0])])
    assert RR.rerank(run, qv, pv, 1).first()["score"] == 0.0


def test_missing_vector_error_or_drop(spark):
    run = spark.createDataFrame([(1, 7, 1), (1, 99, 2)], "qid bigint, pid bigint, rank bigint")
    qv = vec_df(spark, [(1, [1.0, 0.0])], "qid")
    pv = vec_df(spark, [(7, [0.0, 1.0])])
    with pytest.raises(Exception, match="no vector for passage 99"):
        RR.rerank(run, qv, pv, 2).collect()
    assert RR.rerank(run, qv, pv, 2, on_missing="drop").count() == 1
    assert [r["pid"] for r in RR.missing_vectors(run, pv).collect()] == [99]


def test_vector_dim_check(spark, tmp_path):
    from quarry.sources.vectors import read_vectors, write_vectors
    path = str(tmp_path / "v")
    write_vectors(vec_df(spark, [(1, [1.0, 2.0]), (2, [1.0])]), path)
    with pytest.raises(Exception, match="dimension"):
        read_vectors(spark, path, dim=2).collect()


def test_knn_broadcast_and_grid_paths_agree(spark, sf_small):
    vecs = TB.vectors(spark, sf_small)
    queries = vecs.where("id % 40 = 3").select(F.col("id").alias("qid"), "embedding")
    a = KN.knn_exact(vecs, queries, 10).select("qid", "pid", "rank")            # broadcast path
    b = KN.knn_exact(vecs, queries, 10, p_block_rows=50, q_block_rows=4).select("qid", "pid", "rank")  # grid
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0 and a.count() > 0


def test_saved_ann_index_reads_only_probed_cells(spark, sf_small, tmp_path):
    path = str(tmp_path / "vidx")
    vecs = TB.vectors(spark, sf_small)
    AN.VectorIndex.build(vecs, 8).save(path)
    idx = AN.VectorIndex.load(spark, path)
    q = vecs.where("id < 3").select(F.col("id").alias("qid"), "embedding")
    run = idx.search(q, 5, nprobe=2)
    run.write.format("noop").mode("overwrite").save()
    plan = run._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*cell_id", plan)
    assert run.count() == 15


def test_knn_ties_go_to_smaller_ids(spark):
    # 30 identical passages tie for every rank; the 5 smallest ids must win
    rows = [(i, [1.0, 0.0]) for i in range(100, 130)] + [(7, [0.0, 1.0])]
    p = vec_df(spark, rows)
    q = vec_df(spark, [(1, [1.0, 0.0]), (2, [2.0, 0.0])], "qid")
    for kw in ({}, {"p_block_rows": 8, "q_block_rows": 1}):   # broadcast path, grid path
        for qid in (1, 2):
            got = sorted((r["rank"], r["pid"]) for r in
                         KN.knn_exact(p, q, 5, **kw).where(f"qid = {qid}").collect())
            assert got == [(1, 100), (2, 101), (3, 102), (4, 103), (5, 104)]


def test_cell_choice_ties_and_chunking(spark, monkeypatch):
    from quarry.operators import ann
    monkeypatch.setattr(ann, "CELL_SCORES", 3)  # one row per chunk
    cents = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [1.0, 0.0])],
                                  "cell_id bigint, centroid array<float>")
    v = vec_df(spark, [(1, [1.0, 0.0]), (2, [0.0, 1.0])])
    out = {r["id"]: list(r["cells"]) for r in ann.with_nearest_cells(v, "embedding", cents, 2).collect()}
    assert sorted(out[1]) == [0, 1] and 2 in out[2]
