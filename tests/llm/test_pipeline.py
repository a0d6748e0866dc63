"""The corpus pipeline, and the entry point with and without it."""

import os
import random
import shutil
import subprocess
import sys
from collections import Counter

import public_tokenizers
from tokenizers import Tokenizer

import __spark_entry__ as E
import corpus_pipeline
from quarry.llm import catalog, secret_scan, setsketch
from quarry.session import materialize

ROOT = os.path.dirname(os.path.abspath(E.__file__))


def test_stages_on_the_small_tables(spark, sf_small):
    docs = first = spark.read.parquet(f"{sf_small}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        out = materialize(stage(spark, docs, sf_small), name)
        if name != "best_fit_packing":
            assert out.columns == first.columns
            kept[name] = {r.doc_id: r.text for r in out.collect()}
        docs = out if name != "best_fit_packing" else docs
        last = out
    assert set(kept["toxicity"]) <= set(kept["quality_rules"])
    groups = setsketch.groups(spark.createDataFrame(list(kept["toxicity"].items()), "doc_id long, text string"))
    assert set(kept["minhash_near_dedup"]) == {r.doc_id for r in groups.filter("kept").collect()}
    assert not any(secret_scan.base_spans(t) for t in kept["secret_scan"].values())
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = sum(len(library.encode(t, add_special_tokens=False).ids) + 1 for t in kept["secret_scan"].values())
    assert last.agg({"length": "sum"}).first()[0] == want
    assert corpus_pipeline.run(spark, sf_small).count() == last.count()


def test_one_document_of_each_group_stays(spark):
    """Rows of one id with different texts are documents of their own; rows equal in id and text are one."""
    rng = random.Random(2)
    a, b, c = (" ".join(f"{x}{rng.randrange(10 ** 6)}" for _ in range(60)) for x in "abc")
    near = a.rsplit(" ", 1)[0] + " changed"
    rows = [(1, b), (5, a), (5, b), (7, a), (5, a), (9, near), (None, c), (8, c), (3, None), (3, None), (4, "")]
    docs = spark.createDataFrame([(i, t, f"s{k}") for k, (i, t) in enumerate(rows)], "doc_id long, text string, source string")
    kept = Counter((r.doc_id, r.text) for r in setsketch.keep_one(docs).collect())
    assert kept == Counter([(1, b), (5, a), (None, c), (3, None), (4, "")])


def test_stages_of_empty_documents(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, sf_small), name)
        assert docs.count() == 0


def test_every_operator_is_registered_once():
    numbers = sorted(int(n[2:].split("_")[0]) for n in catalog.REGISTRY)
    assert numbers == list(range(1, 14))
    assert set(catalog.REGISTRY) | {"pipeline"} <= set(E.queries())


def test_entry_imports_without_the_subpackage(tmp_path):
    shutil.copytree(ROOT, tmp_path / "repo", ignore=shutil.ignore_patterns("llm", "corpus_pipeline.py", ".git", "__pycache__"))
    said = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(*e.queries())"], cwd=tmp_path / "repo",
                          capture_output=True, text=True, check=True)
    assert "bm25_or" in said.stdout and "op1_" not in said.stdout and "pipeline" not in said.stdout
