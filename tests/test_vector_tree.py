"""Trained two-level index, norm blocks and placed vectors."""

import numpy as np
import pytest

from quarry.operators import ann as AN
from quarry.operators import knn as KN
from quarry.operators import metrics as M
from quarry.operators import norm_blocks as NB
from quarry.operators import rerank as RR
from quarry.operators import vector_table as VP
from quarry.operators import vector_tree as VT
from quarry.session import materialize


def clustered(n=900, dims=12, centres=9, seed=3, spread=0.15, norms=False):
    rng = np.random.default_rng(seed)
    c = rng.normal(size=(centres, dims))
    x = c[rng.integers(0, centres, n)] + rng.normal(size=(n, dims)) * spread
    if norms:
        x *= rng.pareto(1.5, size=(n, 1)) + 0.01
    return x.astype(np.float32)


def frames(spark, x, n_queries=25):
    v = spark.createDataFrame([(int(i), [float(a) for a in r], "clash") for i, r in enumerate(x)],
                              "id long, embedding array<float>, cell_id string")
    q = spark.createDataFrame([(1000 + int(i), [float(a) for a in r]) for i, r in enumerate(x[::len(x) // n_queries])],
                              "qid long, embedding array<float>")
    return v, q


def brute(x, q, k):
    s = q.astype(np.float64) @ x.astype(np.float64).T
    return {(1000 + i, int(p), r + 1) for i, row in enumerate(s)
            for r, p in enumerate(np.lexsort((np.arange(len(x)), -row))[:k])}


def ranks(run):
    return {(r.qid, r.pid, r.rank) for r in run.collect()}


@pytest.mark.parametrize("k", [1, 10, 100])
def test_bounded_search_is_exact_and_reads_few_cells(spark, k):
    x = clustered()
    v, q = frames(spark, x)
    tree = VT.VectorTree.build(v, n_cells=40)
    run, reads = tree.search_with_reads(q, k)
    assert ranks(run) == brute(x, x[::36], k)
    used = tree.stats().first()
    assert used.n_vectors == 900 and used.cells_used > 20
    if k == 1:
        assert reads.count() < 0.7 * q.count() * used.cells_used
    assert reads.count() == reads.distinct().count()


def test_calibrated_recall_holds_and_saves_reads(spark, tmp_path):
    x = clustered(2000, spread=0.3)
    v, q = frames(spark, x, 100)
    VT.VectorTree.build(v, str(tmp_path / "tree"), n_cells=60, calibrate=((10, 0.9), (100, 0.95)))
    tree = VT.VectorTree.load(spark, str(tmp_path / "tree"))
    for k, recall in ((10, 0.9), (5, 0.8), (100, 0.95)):
        run, reads = tree.search_with_reads(q, k, recall=recall)
        exact = KN.knn_exact(v, q, k)
        assert AN.ann_recall(run, exact, k).first().value >= recall
        assert reads.count() < q.count() * tree.cells.count()
    with pytest.raises(ValueError):
        tree.search(q, 1000, recall=0.9)
    with pytest.raises(ValueError):
        tree.search(q, 0)


def test_blocks_samples_and_odd_tables(spark, monkeypatch):
    """Several blocks of a coarse cell and of queries, cells trained on a part of the vectors, repeats and ties."""
    monkeypatch.setattr(VT, "BLOCK_BYTES", 8 * 12 * 40)
    monkeypatch.setattr(VT, "QUERY_BLOCK", 7)
    monkeypatch.setattr(VT, "COARSE_ROWS", 60)
    x = clustered(400)
    x[50:300] = x[7]
    v, q = frames(spark, x)
    tree = VT.VectorTree.build(v, n_cells=12, sample_rows=150)
    assert ranks(tree.search(q, 20)) == brute(x, x[::16], 20)
    few, _ = frames(spark, x[:2], 1)
    tree = VT.VectorTree.build(few)
    assert ranks(tree.search(q, 5)) == {(1000 + i, p, r) for i, p, r in
                                        {(a - 1000, b, c) for a, b, c in brute(x[:2], x[::16], 5)}}
    nothing = VT.VectorTree.build(v.limit(0), calibrate=())
    assert nothing.search(q, 3).count() == 0
    assert tree.search(q.limit(0), 3).count() == 0
    nulls = v.unionByName(spark.createDataFrame([(9999, None, "x")], v.schema))
    assert ranks(VT.VectorTree.build(nulls).search(q, 3)) == brute(x, x[::16], 3)


def test_kmeans_does_not_depend_on_row_order():
    x = clustered(300).astype(np.float64)
    a, b = VT.kmeans(x, 9), VT.kmeans(x[::-1], 9)
    assert np.array_equal(a, b) and len(a) == 9
    assert len(VT.kmeans(np.zeros((5, 3)), 4)) == 1


def test_norm_blocks_skip_and_are_exact(spark):
    x = clustered(1200, norms=True)
    v, q = frames(spark, x)
    blocks = NB.NormBlocks.build(v, block_rows=100)
    run, reads = blocks.search_with_reads(q, 10)
    assert ranks(run) == brute(x, x[::48], 10)
    assert reads.count() < 0.5 * q.count() * len(blocks.blocks)
    assert NB.NormBlocks.build(v.limit(0)).search(q, 3).count() == 0
    same = np.tile(x[3], (300, 1))
    v, q = frames(spark, same)
    assert ranks(NB.NormBlocks.build(v, block_rows=50).search(q, 7)) == brute(same, same[::12], 7)


def test_placed_vectors_are_not_shuffled_and_directories_are_pruned(spark, tmp_path):
    x = clustered(500)
    v, q = frames(spark, x)
    run = KN.knn_exact(v, q, 20)
    want = {tuple(r) for r in RR.rerank(run, q, v, 20).collect()}
    VP.VectorTable.write(v, str(tmp_path / "placed"), directories=16, buckets=4)
    placed = VP.VectorTable.load(spark, str(tmp_path / "placed"))
    assert {tuple(r) for r in RR.rerank(run, q, placed, 20).collect()} == want
    assert {tuple(r) for r in RR.rerank(run, q, placed, 20, broadcast_bytes=None).collect()} == want
    head = materialize(M.truncate_run(run, 1).limit(1).select("pid"), "head")
    plan = placed.lookup(head)
    text = plan._jdf.queryExecution().executedPlan().toString()
    scan = text[text.index("FileScan parquet"):]
    assert "dynamicpruning" in scan and "hashpartitioning(id" not in text
    plan.collect()
    wide = placed.lookup(M.truncate_run(run, 5).select("pid").distinct(), broadcast_bytes=None)
    before = [r.embedding for r in wide.collect()]
    assert len(before) == M.truncate_run(run, 5).select("pid").distinct().count()
    with pytest.raises(ValueError, match="no vector for passage"):
        RR.rerank(run, q, VP.VectorTable.write(v.where("id > 400"), str(tmp_path / "part")), 20)
