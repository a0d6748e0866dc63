"""The command line reproduces the library's evaluation on files."""

import pytest
from pyspark.sql import functions as F

from quarry import cli
from quarry.plans import systems as SY
from quarry.sources import judgments as SJ
from quarry.sources import tables as TB
from quarry.sources import tsv as ST
from quarry.sources import vectors as SV


def test_cli_matches_library(spark, sf_small, tmp_path):
    d = str(tmp_path)
    ST.write_id_text_tsv(TB.passages(spark, sf_small), f"{d}/collection", "doc_id", "text")
    ST.write_id_text_tsv(TB.keyword_queries(spark, sf_small), f"{d}/queries", "qid", "text")
    SV.write_vectors(TB.vectors(spark, sf_small), f"{d}/vectors")
    qrels = SY.saved_judgment_sets(spark, sf_small)
    fmts = {"dev": "triples", "eval_one": "trec", "eval_two": "trec"}
    for name, fmt in fmts.items():
        SJ.write_qrels(qrels.where(F.col("eval_set") == name), f"{d}/qrels_{name}", fmt)
    sets = []
    for name, fmt in fmts.items():
        kind = "dev" if name == "dev" else "eval"
        sets += ["--set", f"{name}={kind},{d}/queries,{d}/qrels_{name},{fmt}"]

    def as_map(rows):
        return {(r["eval_set"], r["metric"], r["k"]): round(r["value"], 9) for r in rows}

    want = {s: as_map(df.collect()) for s, df in [
        ("bm25", SY.evaluate_bm25(spark, sf_small, qrels)),
        ("ann", SY.evaluate_ann(spark, sf_small, qrels)),
        ("cascade", SY.evaluate_cascade(spark, sf_small, qrels))]}

    got = cli.main(["bm25", "--collection", f"{d}/collection", "--passages", f"{d}/vectors",
                    "--depth", "1000", "--out", f"{d}/out", *sets], spark=spark)
    assert as_map(got) == want["bm25"]
    again = cli.main(["bm25", "--collection", f"{d}/collection", "--generated",
                      "--depth", "1000", "--out", f"{d}/out", *sets], spark=spark)
    assert as_map(again) == want["bm25"]
    got = cli.main(["ann", "--passages", f"{d}/vectors", "--query-vectors", f"{d}/vectors",
                    "--depth", "1000", "--recall", "1", "--index", f"{d}/vidx", "--out", f"{d}/out", *sets], spark=spark)
    assert as_map(got) == want["ann"]
    again = cli.main(["ann", "--passages", f"{d}/vectors", "--query-vectors", f"{d}/vectors", "--depth", "1000",
                      "--recall", "1", "--index", f"{d}/vidx", "--out", f"{d}/out", *sets], spark=spark)
    assert as_map(again) == want["ann"]
    flat = ["ann", "--passages", f"{d}/vectors", "--query-vectors", f"{d}/vectors", "--depth", "1000", "--index", f"{d}/flat",
            "--out", f"{d}/out", *sets, "--nprobe"]
    got = cli.main([*flat, "16", "--cells", "16", "--train", "pivots"], spark=spark)     # all cells: exact
    assert as_map(got) == want["ann"]
    assert as_map(cli.main([*flat, "16"], spark=spark)) == want["ann"]
    assert as_map(cli.main([*flat, "1"], spark=spark)) != want["ann"]
    with pytest.raises(SystemExit):
        cli.main(["ann", "--passages", f"{d}/vectors", "--query-vectors", f"{d}/vectors", "--cells", "4",
                  "--index", f"{d}/vidx", "--out", f"{d}/out", *sets], spark=spark)
    with pytest.raises(SystemExit):
        cli.main(["bm25", "--collection", f"{d}/collection", "--generated", "--out", f"{d}/none", *sets], spark=spark)
    got = cli.main(["rerank", "--passages", f"{d}/vectors", "--query-vectors", f"{d}/vectors",
                    "--runs", f"{d}/out/runs/bm25", "--top", "1000",
                    "--out", f"{d}/out", *sets], spark=spark)
    assert as_map(got) == want["cascade"]
