from pyspark.sql import functions as F

from quarry.operators import index as IX
from quarry.operators import search as S


def docs_df(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, text string")


def test_term_freq_sums_to_length(spark, sf_small):
    from quarry.sources import tables as TB
    docs = TB.passages(spark, sf_small)
    tf = IX.term_freq(docs, keep_len=True)
    bad = tf.groupBy("doc_id", "doc_len").agg(F.sum("tf").alias("s")).where(F.col("s") != F.col("doc_len"))
    assert bad.count() == 0
    lengths = IX.doc_lengths(docs).where(F.col("doc_len") > 0)
    assert tf.select("doc_id").distinct().count() == lengths.count()


def test_df_counts_postings(spark, sf_small):
    from quarry.sources import tables as TB
    p = IX.build_postings(TB.passages(spark, sf_small))
    bad = p.groupBy("term", "df").count().where(F.col("count") != F.col("df"))
    assert bad.count() == 0


def test_common_term_has_zero_impact_but_is_returned(spark):
    docs = docs_df(spark, [(1, "alpha beta"), (2, "alpha gamma"), (3, "alpha delta")])
    p = IX.build_postings(docs)
    row = p.where("term = 'alpha'").select(F.max("impact").alias("m"), F.max("impact_q").alias("q")).first()
    assert row["m"] < 0 and row["q"] == 0
    q = spark.createDataFrame([(7, "alpha")], "qid bigint, text string")
    run = S.bm25_search(p, q, k=10).collect()
    assert sorted(r["pid"] for r in run) == [1, 2, 3]


def test_oov_term_or_vs_and(spark):
    docs = docs_df(spark, [(1, "known word here"), (2, "other text"), (3, "more text"), (4, "x y")])
    p = IX.build_postings(docs)
    q = spark.createDataFrame([(1, "known unknownzz")], "qid bigint, text string")
    assert S.bm25_search(p, q, k=10, mode="or").count() == 1
    assert S.bm25_search(p, q, k=10, mode="and").count() == 0


def test_and_subset_of_or_with_equal_scores(spark, sf_small):
    from quarry.sources import tables as TB
    p = IX.build_postings(TB.passages(spark, sf_small))
    q = TB.keyword_queries(spark, sf_small)
    depth = TB.passages(spark, sf_small).count()  # deep enough to keep every candidate
    a = S.bm25_search(p, q, k=depth, mode="and").select("qid", "pid", "score_q")
    o = S.bm25_search(p, q, k=depth, mode="or").select("qid", "pid", "score_q")
    assert a.exceptAll(o).count() == 0


def test_score_tie_smaller_doc_first(spark):
    docs = docs_df(spark, [(5, "same words"), (2, "same words"), (9, "unrelated"), (11, "filler text")])
    p = IX.build_postings(docs)
    q = spark.createDataFrame([(1, "same words")], "qid bigint, text string")
    run = S.bm25_search(p, q, k=10).orderBy("rank").collect()
    assert [r["pid"] for r in run] == [2, 5]
    assert [r["rank"] for r in run] == [1, 2]


def test_topk_ranks_dense(spark, sf_small):
    from quarry.sources import tables as TB
    p = IX.build_postings(TB.passages(spark, sf_small))
    run = S.bm25_search(p, TB.keyword_queries(spark, sf_small), k=7)
    per = run.groupBy("qid").agg(F.count("*").alias("n"), F.max("rank").alias("m"),
                                 F.countDistinct("rank").alias("d"))
    assert per.where((F.col("n") != F.col("m")) | (F.col("n") != F.col("d")) | (F.col("n") > 7)).count() == 0


def test_empty_query_gives_no_rows(spark):
    docs = docs_df(spark, [(1, "a b"), (2, "c d")])
    q = spark.createDataFrame([(1, "  ...  ")], "qid bigint, text string")
    assert S.bm25_search(IX.build_postings(docs), q, k=5).count() == 0


def test_avg_len_is_truncated(spark):
    docs = docs_df(spark, [(1, "a b c"), (2, "a b")])
    st = IX.collection_stats(IX.doc_lengths(docs)).first()
    assert (st["n_docs"], st["total_len"], st["avg_len"]) == (2, 5, 2.0)
    st = IX.collection_stats(IX.doc_lengths(docs), avg_mode="exact").first()
    assert st["avg_len"] == 2.5


def test_lexicon_and_posting_extents(spark):
    docs = docs_df(spark, [(i, "hot hot" if i == 5 else "hot") for i in range(129)] + [(1000, "cold")])
    tf = IX.term_freq(docs)
    assert sorted(map(tuple, IX.lexicon(tf).collect())) == [("cold", 1, 1), ("hot", 129, 130)]
    assert sorted(map(tuple, IX.posting_profile(tf).collect())) == [("cold", 1, 1000, 1000, 1), ("hot", 129, 0, 128, 2)]
    assert [r["term"] for r in IX.vocabulary(tf).collect()] == ["cold", "hot"]


def test_mean_length_zero_and_empty_table(spark):
    """A mean length that truncates to 0 makes every weight 0; an empty table has no mean."""
    docs = docs_df(spark, [(1, "only"), (2, ""), (3, None), (4, "")])
    for post in (IX.build_postings(docs), IX.TextIndex.build(docs).postings):
        assert [(r["impact"], r["impact_q"]) for r in post.collect()] == [(0.0, 0)]
    assert {r["doc_len"] for r in IX.doc_lengths(docs).collect()} == {0, 1}
    empty = IX.collection_stats(IX.doc_lengths(docs.limit(0))).first()
    assert (empty["n_docs"], empty["total_len"], empty["avg_len"]) == (0, 0, None)
    assert IX.build_postings(docs.limit(0)).count() == 0


def test_counts_are_placed_before_they_are_written(spark, sf_small):
    from quarry.sources import tables as TB
    idx = IX.TextIndex.build(TB.passages(spark, sf_small), n_buckets=5)
    plan = idx.tf.groupBy("doc_id").count()._jdf.queryExecution().toString()
    assert "Exchange hashpartitioning(doc_id" not in plan
    assert idx.tf.groupBy("doc_id").agg({"tf": "sum"}).count() > 0


def test_index_save_load_roundtrip(spark, sf_small, tmp_path):
    from quarry.sources import tables as TB
    docs = TB.passages(spark, sf_small)
    idx = IX.TextIndex.build(docs)
    path = str(tmp_path / "idx")
    idx.save(path)
    back = IX.TextIndex.load(spark, path)
    cols = ["term", "doc_id", "impact_q"]
    assert back.postings.select(cols).exceptAll(idx.postings.select(cols)).count() == 0
    assert back.postings.count() == idx.postings.count()
    assert back.params["avg_mode"] == "floor"
    assert back.saved_lexicon(path).count() == idx.postings.select("term").distinct().count()
    q = TB.keyword_queries(spark, sf_small)
    cols = ["qid", "pid", "rank", "score_q"]
    assert back.search(q, k=20).select(cols).exceptAll(S.bm25_search(idx.postings, q, k=20).select(cols)).count() == 0


def test_bucketed_index_search_shuffles_only_topk(spark, sf_small, tmp_path):
    from quarry.sources import tables as TB
    path = str(tmp_path / "bidx")
    IX.TextIndex.build(TB.passages(spark, sf_small)).save(path, n_buckets=4)
    idx = IX.TextIndex.load(spark, path)
    run = idx.search(TB.keyword_queries(spark, sf_small), k=10)
    run.write.format("noop").mode("overwrite").save()
    plan = run._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan
    assert "dynamicpruningexpression" in plan  # only the batch's term buckets are read
    # the only hash exchange is the one on qid, after the partial top-k
    assert plan.count("Exchange hashpartitioning") == 1
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_query_time_weights_equal_index_time_weights(spark, sf_small):
    from quarry.sources import tables as TB
    docs, q = TB.passages(spark, sf_small), TB.keyword_queries(spark, sf_small)
    cols = ["qid", "pid", "rank", "score_q"]
    for mode in ("or", "and"):
        a = IX.TextIndex.build(docs).search(q, k=50, mode=mode).select(cols)
        b = S.bm25_search(IX.build_postings(docs), q, k=50, mode=mode).select(cols)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_lengths_from_counts_keep_token_less_documents(spark):
    docs = docs_df(spark, [(1, "a b a"), (2, "... !!!"), (3, "c")])
    idx = IX.TextIndex.build(docs)
    got = sorted(map(tuple, idx.doc_lengths.collect()))
    assert got == [(1, 3), (2, 0), (3, 1)]
    st = idx.stats.first()
    assert (st["n_docs"], st["total_len"], st["avg_len"]) == (3, 4, 1.0)


def test_saved_lexicon_lookup_is_pruned(spark, sf_small, tmp_path):
    from quarry.sources import tables as TB
    path = str(tmp_path / "lidx")
    IX.TextIndex.build(TB.passages(spark, sf_small)).save(path, term_buckets=8)
    idx = IX.TextIndex.load(spark, path)
    run = idx.search(TB.keyword_queries(spark, sf_small).limit(1), k=5)
    run.write.format("noop").mode("overwrite").save()
    plan = run._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.split("\n") if "FileScan" in line]
    counts = [x for x in scans if "quarry_postings_" in x]
    lexicon = [x for x in scans if "ReadSchema: struct<term:string,df:bigint>" in x]
    assert counts and all("dynamicpruning" in x for x in counts)
    assert lexicon and all("dynamicpruning" in x for x in lexicon)


def test_build_in_place_then_save_and_resave(spark, sf_small, tmp_path):
    from quarry.sources import tables as TB
    docs, q = TB.passages(spark, sf_small), TB.keyword_queries(spark, sf_small)
    path = str(tmp_path / "inplace")
    idx = IX.TextIndex.build(docs, path=path)
    idx.save(path)            # counts were written by build: kept, not rewritten
    idx.save(path)            # already saved: a no-op
    back = IX.TextIndex.load(spark, path)
    back.save(path)           # a loaded index is not rewritten over itself
    cols = ["qid", "pid", "rank", "score_q"]
    a = back.search(q, k=20).select(cols)
    b = S.bm25_search(IX.build_postings(docs), q, k=20).select(cols)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_hot_term_through_skew_split_join(spark):
    """A term in every document, with the df join forced onto the shuffle
    path and AQE's skew split forced on: weights equal the brute force."""
    import math
    rows = [(i, f"hot w{i % 7} w{i % 3} hot") for i in range(400)]
    docs = docs_df(spark, rows)
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1024"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        got = {(r["term"], r["doc_id"]): r["impact_q"] for r in IX.build_postings(docs).collect()}
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    n, avg = 400, 4
    df = {"hot": 400}
    for i in range(7):
        df[f"w{i}"] = sum(1 for j in range(400) if j % 7 == i)
    for i in range(3):
        df[f"w{i}"] = df.get(f"w{i}", 0) + sum(1 for j in range(400) if j % 3 == i and j % 7 != i)

    def q(s):
        return 0 if s <= 0 else 255 if s >= 30 else int(s / 30.0 * 255)

    for (term, d), iq in got.items():
        tf = 2 if term == "hot" else (2 if d % 7 == d % 3 and term == f"w{d % 7}" else 1)
        idf = math.log((n - df[term] + 0.5) / (df[term] + 0.5))
        want = q(idf * (2.2 * tf) / (1.2 * (0.25 + 0.75 * (4 / avg)) + tf))
        assert iq == want, (term, d)
    assert sum(1 for t, _ in got if t == "hot") == 400
