"""Neighbour graph by propagation, against brute force."""

import numpy as np
import pytest

from quarry.operators import neighbor_graph as NG


def frame(spark, x):
    return spark.createDataFrame([(int(i), [float(a) for a in r], "clash") for i, r in enumerate(x)],
                                 "id long, embedding array<float>, member string")


def test_recall_of_clusters_and_of_noise(spark, monkeypatch):
    monkeypatch.setattr(NG, "BLOCK_ROWS", 64)
    rng = np.random.default_rng(2)
    for spread in (0.2, 1.0):
        x = (rng.normal(size=(30, 16))[rng.integers(0, 30, 900)] + rng.normal(size=(900, 16)) * spread).astype(np.float32)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        v = frame(spark, x)
        graph = NG.neighbor_graph(v, m=10)
        rows = graph.collect()
        assert len(rows) == 9000 and all(r.id != r.other for r in rows)
        s = x.astype(np.float64) @ x.T.astype(np.float64)
        np.fill_diagonal(s, -np.inf)
        near = {(i, int(p)) for i in range(900) for p in np.lexsort((np.arange(900), -s[i]))[:10]}
        recall = len(near & {(r.id, r.other) for r in rows}) / len(near)
        assert recall >= 0.9
        assert all(abs(r.score - s[r.id, r.other]) < 1e-6 for r in rows[:500])
        measured = NG.graph_recall(v, graph, 10).first()
        assert measured.n_vectors == 900 and abs(measured.recall - recall) < 1e-3


def test_hubs_repeats_and_small_tables(spark, monkeypatch):
    monkeypatch.setattr(NG, "BLOCK_ROWS", 32)
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 8)).astype(np.float32)
    x[0] *= 50                                   # everybody's neighbour, or nobody's
    x[100:250] = x[7]
    graph = NG.neighbor_graph(frame(spark, x), m=5)
    assert {r["count"] for r in graph.groupBy("id").count().collect()} == {5}
    few = NG.neighbor_graph(frame(spark, x[:4]), m=5)
    assert few.count() == 12
    assert NG.neighbor_graph(frame(spark, x).limit(0), m=5).count() == 0
    assert NG.neighbor_graph(frame(spark, x[:1]), m=5).count() == 0
    nulls = frame(spark, x[:4]).unionByName(spark.createDataFrame([(9, None, "x")], "id long, embedding array<float>, member string"))
    assert NG.neighbor_graph(nulls, m=5).count() == 12
    with pytest.raises(ValueError):
        NG.neighbor_graph(nulls, m=0)
