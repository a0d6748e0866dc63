"""Exact search by rising bars, its grid, and graph rounds that emit only what can enter a list."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.operators import knn as KN
from quarry.operators import neighbor_graph as NG


def best_of(kernel):
    rows = kernel.table().to_pandas().sort_values(["qid", "score", "pid"], ascending=[True, False, True])
    return {q: list(g["pid"]) for q, g in rows.groupby("qid")}


@pytest.mark.parametrize("n, n_q, k, dims, kinds, scale", [
    (3000, 40, 10, 64, 3000, 1.0), (3000, 40, 100, 64, 3000, 1.0), (3000, 40, 10, 16, 60, 1.0), (2500, 9, 10, 8, 1, 1.0),
    (3000, 20, 10, 64, 3000, 1e-25), (3000, 20, 10, 64, 3000, 1e30), (5, 3, 10, 4, 5, 1.0)])
def test_bars_lose_nothing(n, n_q, k, dims, kinds, scale):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(kinds, dims)).astype(np.float32).astype(np.float64)[rng.integers(0, kinds, n) if kinds < n else np.arange(n)]
    q, ids = x[:n_q] * scale, rng.permutation(n).astype(np.int64)
    reads = rng.random((n_q, 4)) < 0.6, rng.integers(0, 4, n)
    for mask in (None, reads):
        kernel = KN.RunningTopK(np.arange(n_q), q, k)
        for at in range(0, n, 1100):
            kernel.add(ids[at:at + 1100], x[at:at + 1100], None if mask is None else (mask[0], mask[1][at:at + 1100]))
        s = np.stack([np.einsum("j,ij->i", a, x) for a in q])
        for i in range(n_q):
            able = np.arange(n) if mask is None else np.flatnonzero(mask[0][i, mask[1]])
            want = [int(ids[j]) for j in able[np.lexsort((ids[able], -s[i, able].round(9)))][:k]] if scale == 1 else \
                [int(ids[j]) for j in able[np.lexsort((ids[able], -s[i, able]))][:k]]
            assert best_of(kernel).get(i, []) == want


def test_a_vector_that_is_not_finite():
    x = np.random.default_rng(7).normal(size=(600, 8))
    x[5] = np.nan
    kernel = KN.RunningTopK(np.arange(3), x[:3], 4)
    kernel.add(np.arange(600), x)
    s = np.where(np.isnan(x[:3] @ x.T), -np.inf, x[:3] @ x.T)
    assert best_of(kernel) == {i: [int(j) for j in np.argsort(-s[i])[:4]] for i in range(3)}


def test_copies_of_a_passage_follow_the_memory_of_a_cell():
    assert KN._grid(615_000, 615_000, 65536, 4096, 12) == (10, 10)       # one for each 4096 queries: 151 copies
    assert KN._grid(51_282, 51_282, 65536, 4096, 8) == (1, 13)
    assert KN._grid(100, 10, 65536, 4096, 8) == (1, 1)


def test_a_round_emits_what_reaches_the_list(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(300, 8)).astype(np.float32)
    vectors = spark.createDataFrame([(i, [float(a) for a in r]) for i, r in enumerate(x)], "id bigint, embedding array<float>")
    s = x.astype(np.float64) @ x.T.astype(np.float64)
    lists = {i: [int(j) for j in rng.permutation(300)[:6] if j != i][:5] for i in range(300)}
    edges = spark.createDataFrame([(i, j, float(s[i, j])) for i, some in lists.items() for j in some],
                                  "id bigint, other bigint, score double")
    bar = {i: min(s[i, j] for j in some) for i, some in lists.items()}
    got = {(r.id, r.other) for r in NG._round(vectors, edges, 5, 0).collect()}
    assert got and all(s[i, j] >= bar[i] - 1e-9 and i != j for i, j in got)
    for at, some in lists.items():       # forward lists are whole
        members = [at, *some]
        assert {(i, j) for i in members for j in members if i != j and s[i, j] > bar[i] + 1e-9} <= got
    more = edges.withColumn("new", F.lit(False)).unionByName(NG._round(vectors, edges, 5, 0).withColumn("new", F.lit(True)))
    old = {(i, j) for i, some in lists.items() for j in some}
    merged = NG._merged(more, 5).collect()
    assert len(merged) == 1500 and all(r.new == ((r.id, r.other) not in old) for r in merged)
