"""Packed counts as whole strings, document frequencies kept between a search and a containment test, pruned sorts."""

from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from quarry.operators import index as IX
from quarry.operators import packed as PK
from quarry.operators import search as S

TEXTS = [None, "", "é ٠ -", "a", "b", "b a b", "ab", "x" * 50, "", None, "z\n", "1 1 12", "A-b1_A", "a " * 300 + "c"]


@pytest.mark.parametrize("cut", [(0, len(TEXTS)), (3, 6), (9, 1), (1, 2)])
def test_counts_of_texts_in_one_buffer_are_those_of_each_text(cut):
    some = pa.array(TEXTS).slice(*cut)
    lengths, terms, tfs = PK._counted(some)
    got = [{} for _ in range(len(some))]
    for term, row, tf in zip(PK.words(terms)[0].to_pylist(), PK.words(terms)[1], PK.words(tfs)[0].cast(pa.int64()).to_pylist()):
        got[row][term] = tf
    want = [Counter((t or "").encode().translate(PK.SEPARATE).decode().split()) for t in some.to_pylist()]
    assert got == [dict(w) for w in want] and lengths.to_pylist() == [w.total() for w in want]


def test_terms_are_stored_as_strings_and_unpacked(spark, monkeypatch):
    monkeypatch.setattr(PK, "PACK_BYTES", 20)
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id bigint, text string")
    index = IX.TextIndex.build(docs, n_buckets=2)
    assert dict(index.packed.dtypes)["terms"] == dict(index.packed.dtypes)["tfs"] == "string"
    cols = ("term", "doc_id", "doc_len", "tf")
    assert sorted(map(tuple, index.tf.select(*cols).collect())) == \
        sorted(map(tuple, IX.term_freq(docs, keep_len=True).select(*cols).collect()))


def test_frequencies_that_a_search_counted_need_no_second_pass(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id bigint, text string")
    index = IX.TextIndex.build(docs, n_buckets=2)
    index.search(spark.createDataFrame([(1, "a b gone"), (2, "c 1")], "qid bigint, text string"), k=3)
    asked = spark.createDataFrame([("a",), ("gone",), ("1",)], "term string")
    found = index.frequencies(asked)
    assert "MapInArrow" not in found._jdf.queryExecution().executedPlan().toString()
    want = IX.doc_freq(index.tf).where("term in ('a', '1')")
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, want.collect()))
    # those of another batch are counted afresh
    other = index.search(spark.createDataFrame([(1, "z ab")], "qid bigint, text string"), k=3)
    assert {r["pid"] for r in other.collect()} == {6, 10}


@pytest.mark.parametrize("k", [1, 3, 50])
def test_rows_below_the_score_at_k_are_left_out_before_the_sort(monkeypatch, k):
    import pandas as pd
    rng = np.random.default_rng(5)
    asks = S._Asks(pd.DataFrame({"q": [0, 1, 2], "t": [0, 1, 2], "n_terms": 1}), k, "or")
    n = 400
    some = [rng.integers(0, 2, n), rng.permutation(n), rng.random(n) > 0.1, rng.integers(0, 9, n), np.ones(n, np.int64)]
    sizes, real = [], np.lexsort
    monkeypatch.setattr(np, "lexsort", lambda keys: sizes.append(len(keys[0])) or real(keys))
    pruned = asks.best(some)
    monkeypatch.setattr(S, "SCORE_CELLS", 0)
    whole = asks.best(some)
    assert sizes[0] < sizes[1] == n
    assert all((a == b).all() for a, b in zip(pruned[0], whole[0])) and (pruned[1] == whole[1]).all()
