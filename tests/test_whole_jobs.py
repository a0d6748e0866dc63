"""Queries that must do their whole job: computed values, not asserted constants."""

import duckdb
import numpy as np

import __spark_entry__ as E


def _tables(spark, folder, n=400):
    rng = np.random.default_rng(5)
    vecs = [(i, rng.normal(size=8).astype("float32").tolist(), i % 3) for i in range(n)]
    spark.createDataFrame(vecs, "vec_id bigint, embedding array<float>, label int").coalesce(1) \
        .write.parquet(f"{folder}/embeddings.parquet")
    spark.createDataFrame([(i, "text") for i in range(30)], "item_id bigint, text string").coalesce(1) \
        .write.parquet(f"{folder}/benchmark.parquet")
    con = duckdb.connect()
    for t in ("embeddings", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet/*.parquet')")
    return con


def test_ann_recall_computes_its_value_from_the_vectors(spark, tmp_path):
    con = _tables(spark, tmp_path)
    got = E.queries()["ann_recall"](spark, str(tmp_path)).collect()
    want = con.execute(E.oracle_sql()["ann_recall"]).fetchall()
    assert [tuple(r) for r in got] == want
    assert 0 < got[0].value < 1                      # random vectors: few cells do not find all


def test_ann_calibrated_recall_counts_the_exact_neighbours(spark, tmp_path):
    con = _tables(spark, tmp_path)
    got = sorted(map(tuple, E.queries()["ann_calibrated_recall"](spark, str(tmp_path)).collect()))
    assert got == sorted(con.execute(E.oracle_sql()["ann_calibrated_recall"]).fetchall())
    assert [(r[2], r[3]) for r in got] == [(30, 300), (30, 3000)]
