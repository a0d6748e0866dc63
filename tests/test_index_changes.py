"""Bounded search, index segments, term ids and run manifests."""

import random

import pytest
from pyspark.sql import functions as F

from quarry.operators import bounded as BD
from quarry.operators import index as IX
from quarry.operators import segments as SG
from quarry.operators import term_ids as TI
from quarry.sources import runs as SR


def texts(n, seed=1):
    """Texts of stop words, common and rare words; some empty and null."""
    rng = random.Random(seed)
    word = lambda: rng.choice(["the", "of", "of", *(f"c{i}" for i in range(12)), f"r{rng.randrange(200)}"])
    rows = [(i, " ".join(word() for _ in range(rng.choice([3, 10, 40])))) for i in range(n)]
    return rows + [(n, ""), (n + 1, None), (n + 2, "?!")]


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


QUERIES = [(1, "the of r1 r2"), (2, "c1 c2 c3 of"), (3, "the"), (4, "r7 unknown c5 the of"), (5, ""), (6, "unknown"),
           (7, " ".join(f"c{i}" for i in range(12)) + " the of r3 r4 r5")]


def queries(spark):
    return spark.createDataFrame(QUERIES, "qid long, text string")


def rows_of(run):
    return {tuple(r) for r in run.select("qid", "pid", "rank", "score", "score_q").collect()}


@pytest.mark.parametrize("saved", [False, True])
@pytest.mark.parametrize("k", [1, 5, 1000])
def test_bounded_search_equals_or(spark, tmp_path, k, saved):
    docs = frame(spark, texts(700))
    idx = IX.TextIndex.build(docs, path=str(tmp_path / "idx") if saved else None)
    if saved:
        idx.save(str(tmp_path / "idx"))
        idx = IX.TextIndex.load(spark, str(tmp_path / "idx"))
    bounded = BD.BoundedIndex.build(idx, str(tmp_path / "bounds"), n_blocks=16)
    bounded = BD.BoundedIndex.load(spark, idx, str(tmp_path / "bounds"))
    assert bounded.n_blocks == 16
    run, work = bounded.search_with_rows(queries(spark), k=k)
    assert rows_of(run) == rows_of(idx.search(queries(spark), k=k))
    if k == 5:          # the query of frequent terms and a few rare ones reads a part of the matching postings
        matched = idx.tf.where(F.col("term").isin(QUERIES[0][1].split())).count()
        read = work.where("qid = 1").agg(F.sum("rows")).first()[0]
        assert read < matched / 2


def test_bounded_search_over_the_tables(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text")
    q = spark.read.parquet(f"{sf_small}/benchmark.parquet").selectExpr("item_id AS qid", "text")
    idx = IX.TextIndex.build(docs)
    bounded = BD.BoundedIndex.build(idx)
    run, work = bounded.search_with_rows(q, k=10)
    assert rows_of(run) == rows_of(idx.search(q, k=10))
    empty = BD.BoundedIndex.build(IX.TextIndex.build(docs.limit(0)))
    assert empty.search(q, k=10).count() == 0
    assert bounded.search(q.limit(0), k=10).count() == 0


def test_segments_follow_additions_replacements_and_deletions(spark, tmp_path):
    a, b = texts(120, 2), [(i + 100, t) for i, t in texts(90, 3)]          # ids 100.. of a are replaced by b
    gone = [5, 7, 110, 150, 9999]
    live = {**dict(a), **dict(b)}
    fresh = lambda rows: IX.TextIndex.build(frame(spark, sorted(rows.items())))
    idx = SG.SegmentedIndex(spark, str(tmp_path / "seg"))
    assert idx.search(queries(spark), 10).count() == 0
    idx.add(frame(spark, a))
    idx.add(frame(spark, b))
    assert rows_of(idx.search(queries(spark), 50)) == rows_of(fresh(live).search(queries(spark), 50))
    idx.delete(spark.createDataFrame([(i,) for i in gone], "doc_id long"))
    for i in gone:
        live.pop(i, None)
    want = fresh(live)
    again = SG.SegmentedIndex(spark, str(tmp_path / "seg"))
    for idx in (idx, again):
        assert rows_of(idx.search(queries(spark), 50)) == rows_of(want.search(queries(spark), 50))
        assert rows_of(idx.search(queries(spark), 50, "and")) == rows_of(want.search(queries(spark), 50, "and"))
        assert {tuple(r) for r in idx.doc_freq().collect()} == {tuple(r) for r in want.dfreq.select("term", "df").collect()}
        assert tuple(idx.stats().first()) == tuple(want.stats.first())
    again.compact()
    assert len(again._segments()) == 1
    assert rows_of(again.search(queries(spark), 50)) == rows_of(want.search(queries(spark), 50))
    again.add(frame(spark, [(7, "the r1 c1"), (5000, "r2 of")]))
    again.delete(spark.createDataFrame([(5000,)], "doc_id long"))
    live[7] = "the r1 c1"
    assert rows_of(again.search(queries(spark), 50)) == rows_of(fresh(live).search(queries(spark), 50))
    for bad in ([(1, "a"), (1, "b")], [(None, "a")]):
        with pytest.raises(ValueError):
            again.add(frame(spark, bad))


def test_a_step_that_did_not_finish_changes_nothing(spark, tmp_path, monkeypatch):
    idx = SG.SegmentedIndex(spark, str(tmp_path / "seg"))
    idx.add(frame(spark, texts(40)))
    want = rows_of(idx.search(queries(spark), 20))
    with monkeypatch.context() as m:
        m.setattr(SG.SegmentedIndex, "_done", lambda *a, **k: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            SG.SegmentedIndex(spark, str(tmp_path / "seg")).add(frame(spark, texts(40, 9)))
    idx = SG.SegmentedIndex(spark, str(tmp_path / "seg"))
    assert rows_of(idx.search(queries(spark), 20)) == want
    idx.add(frame(spark, texts(40, 9)))
    assert rows_of(idx.search(queries(spark), 20)) == rows_of(IX.TextIndex.build(frame(spark, texts(40, 9))).search(queries(spark), 20))


def test_term_ids_are_dense_and_in_byte_order(spark):
    terms = sorted({f"{c}{i}" for c in "aZz09" for i in range(300)}, key=str.encode)
    tf = spark.createDataFrame([(t, 1) for t in terms + terms[::3]] + [(None, 1)], "term string, tf int")
    got = TI.term_ids(tf)
    assert {r.term: r.term_id for r in got.collect()} == {t: i for i, t in enumerate(terms)}
    assert "SinglePartition" not in got._jdf.queryExecution().executedPlan().toString()
    assert TI.with_term_ids(tf, got).where(f"term_id = {terms.index('a0')}").count() == (2 if "a0" in terms[::3] else 1)
    assert TI.term_ids(tf.limit(0)).count() == 0


def test_a_changed_table_or_parameter_rebuilds_a_run(spark, tmp_path):
    docs_path, path = str(tmp_path / "docs"), str(tmp_path / "run")
    built = []

    def run(k):
        docs = spark.read.parquet(docs_path)
        build = lambda: built.append(k) or IX.TextIndex.build(docs).search(queries(spark), k=k)
        return SR.load_or_build_run(spark, path, build, {"documents": docs, "queries": queries(spark)}, {"k": k}).count()

    frame(spark, texts(60)).write.parquet(docs_path)
    first = run(5)
    assert run(5) == first and built == [5]
    assert run(7) > first and built == [5, 7]
    frame(spark, texts(50, 4)).write.mode("overwrite").parquet(docs_path)
    spark.catalog.refreshByPath(docs_path)
    run(7)
    assert built == [5, 7, 7]
    assert run(7) and built == [5, 7, 7]
    assert SR.read_manifest(spark, str(tmp_path / "none")) is None
