import pytest
from pyspark.sql import functions as F

from quarry.operators import metrics as M
from quarry.sources.judgments import checked_unique


def run_df(spark, lists):
    rows = [(q, p, i + 1) for q, ps in lists.items() for i, p in enumerate(ps)]
    return spark.createDataFrame(rows, "qid bigint, pid bigint, rank bigint")


def qrels_df(spark, rows):
    return spark.createDataFrame(rows, "qid bigint, pid bigint, rel int")


def value(df):
    return round(df.first()["value"], 6)


def test_mrr_example(spark):
    run = run_df(spark, {1: [3, 1, 4, 2], 2: [5, 6, 7, 8], 3: [9, 10, 11, 12]})
    q = qrels_df(spark, [(1, 1, 1), (3, 9, 1)])
    assert value(M.mrr(run, q, None)) == 0.75


def test_recall_example(spark):
    run = run_df(spark, {1: [3, 1, 4, 2], 2: [5, 6, 7, 8]})
    q = qrels_df(spark, [(1, 1, 1), (1, 2, 1), (1, 5, 1), (2, 7, 1), (2, 9, 1)])
    assert value(M.recall(run, q, None)) == 0.583333


def test_map_example(spark):
    run = run_df(spark, {1: [1, 2, 3, 4]})
    q = qrels_df(spark, [(1, 1, 1), (1, 4, 1)])
    assert value(M.mean_ap(run, q, None)) == 0.75


def test_ndcg_example(spark):
    run = run_df(spark, {1: [1, 2, 3]})
    q = qrels_df(spark, [(1, 1, 1), (1, 2, 3), (1, 3, 2)])
    assert value(M.ndcg(run, q, None)) == 0.736364


def test_empty_run_gives_zero(spark):
    run = spark.createDataFrame([], "qid bigint, pid bigint, rank bigint")
    q = qrels_df(spark, [(1, 1, 1)])
    for fn in (M.mrr, M.recall, M.mean_ap, M.ndcg):
        assert value(fn(run, q, 10)) == 0.0


def test_ideal_run_has_ndcg_one(spark):
    run = run_df(spark, {1: [2, 3, 1]})
    q = qrels_df(spark, [(1, 1, 1), (1, 2, 3), (1, 3, 2)])
    assert value(M.ndcg(run, q, None)) == 1.0


def test_zero_rel_is_not_relevant_and_zero_ideal_counts(spark):
    run = run_df(spark, {1: [1, 2], 2: [3]})
    q = qrels_df(spark, [(1, 1, 0), (1, 2, 2)])
    assert value(M.mrr(run, q, None)) == 0.5
    # query 2 has no judgment: NDCG 0 and still counted in the mean
    per = {r["qid"]: r for r in M.per_query_metrics(run, q, None).collect()}
    assert per[2]["ndcg"] == 0.0 and per[2]["recall"] is None
    assert value(M.ndcg(run, q, None)) == round(per[1]["ndcg"] / 2, 6)


def test_truncation(spark):
    run = run_df(spark, {1: [5, 6, 1]})
    q = qrels_df(spark, [(1, 1, 1)])
    assert value(M.mrr(run, q, 2)) == 0.0
    assert value(M.mrr(run, q, 3)) == round(1 / 3, 6)


def test_recall_monotone_in_k(spark, sf_small):
    from quarry.plans import catalog as C
    run = C._run(spark, sf_small)
    q = C._graded(spark, sf_small, run)
    vals = [value(M.recall(run, q, k)) for k in (5, 20, 100)]
    assert vals == sorted(vals)


def test_duplicate_judgment_raises(spark):
    q = checked_unique(qrels_df(spark, [(1, 1, 1), (1, 1, 2), (2, 3, 1)]))
    with pytest.raises(Exception, match="duplicate judgment"):
        q.collect()


def test_precision_at_hits(spark):
    run = run_df(spark, {1: [1, 2, 3, 4]})
    q = qrels_df(spark, [(1, 1, 1), (1, 4, 1)])
    got = sorted((r["rank"], r["precision"]) for r in M.precision_at_hits(run, q, None).collect())
    assert got == [(1, 1.0), (4, 0.5)]


def test_run_lists_order(spark):
    run = run_df(spark, {1: [9, 3, 5]})
    assert M.run_lists(run).first()["pids"] == [9, 3, 5]


def test_containment_short_and_long_queries(spark):
    from quarry.plans.judgments import containment_qrels
    docs = spark.createDataFrame([(1, "the quick brown fox jumps"), (2, "a quickbrown fox"),
                                  (3, "xx brown fox jumps yy")], "doc_id bigint, text string")
    q = spark.createDataFrame([(10, "quick brown fox"), (11, "brown fox jumps"), (12, "uick"),
                               (13, "fox")], "qid bigint, text string")
    got = sorted((r["qid"], r["pid"]) for r in containment_qrels(docs, q).collect())
    assert got == [(10, 1), (11, 1), (11, 3), (12, 1), (12, 2), (13, 1), (13, 2), (13, 3)]


def test_evaluate_reports_every_spec_cell(spark):
    from quarry.plans.systems import evaluate
    run = spark.createDataFrame([("dev", 1, 5, 1)], "eval_set string, qid bigint, pid bigint, rank bigint")
    q = spark.createDataFrame([("dev", 1, 5, 1), ("eval_one", 2, 7, 2)],
                              "eval_set string, qid bigint, pid bigint, rel int")
    spec = [("dev", "mrr", 10), ("eval_one", "ndcg", 10)]
    got = {(r["eval_set"], r["metric"]): r["value"] for r in evaluate(run, q, "x", spec).collect()}
    assert got == {("dev", "mrr"): 1.0, ("eval_one", "ndcg"): 0.0}


def test_multi_depth_pass_equals_single_depth(spark, sf_small):
    from quarry.plans import catalog as C
    run = C._run(spark, sf_small)
    q = C._graded(spark, sf_small, run)
    multi = M.per_query_metrics_at(run, q, [3, 10, 100]).collect()
    cols = ["n_rel", "n_hits", "rr", "recall", "ap", "ndcg"]
    for k in (3, 10, 100):
        want = {r["qid"]: tuple(r[c] for c in cols) for r in M.per_query_metrics(run, q, k).collect()}
        got = {r["qid"]: tuple(r[c] for c in cols) for r in multi if r["k"] == k}
        assert set(got) == set(want)
        for qid in want:
            for a, b in zip(got[qid], want[qid]):
                assert (a is None and b is None) or abs(a - b) < 1e-12
