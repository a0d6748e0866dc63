"""Command-line runs of the three retrieval systems over files.

    python -m quarry.cli bm25   --collection C.tsv --set dev=dev,Q.tsv,QR.tsv,triples ... --out DIR
    python -m quarry.cli ann    --passages P.parquet --query-vectors QV.parquet --set ... --out DIR
    python -m quarry.cli rerank --passages P.parquet --query-vectors QV.parquet --runs DIR/runs/bm25
                                --set ... --top 1000 --out DIR

``--set NAME=KIND,QUERIES,QRELS,FMT``: KIND is ``dev`` (MRR@10, Recall@100,
MAP@100) or ``eval`` (MRR@10, NDCG@10, NDCG@100); QUERIES is an id<TAB>text
file (``-`` where no text is needed); FMT is ``triples`` or ``trec``. Each
set's queries are restricted to the ones its judgments mention. Runs are
written per set below ``--out`` (Parquet, rank kept); metrics are printed as
one JSON line per (system, set, metric, k). Everything runs as Spark jobs
on the session's cluster; ``--master`` is only for local use.
"""

from __future__ import annotations

import argparse
import json
import time
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from quarry.operators import ann as AN
from quarry.operators import filters as FL
from quarry.operators import index as IX
from quarry.operators import rerank as RR
from quarry.operators import vector_tree as VT
from quarry.plans import systems as SY
from quarry.session import get_session
from quarry.sources import judgments as SJ
from quarry.sources import runs as SR
from quarry.sources import tsv as ST
from quarry.sources import vectors as SV

DEV = [("mrr", 10), ("recall", 100), ("map", 100)]
EVAL = [("mrr", 10), ("ndcg", 10), ("ndcg", 100)]


def parse_set(text: str) -> dict:
    name, _, rest = text.partition("=")
    parts = rest.split(",")
    if not name or len(parts) != 4 or parts[0] not in ("dev", "eval"):
        raise argparse.ArgumentTypeError(f"bad --set {text!r}: NAME=KIND,QUERIES,QRELS,FMT")
    return {"name": name, "kind": parts[0], "queries": parts[1], "qrels": parts[2], "fmt": parts[3]}


def load_sets(spark: SparkSession, sets: list[dict]) -> tuple[DataFrame, list]:
    """(eval_set, qid, pid, rel) of all sets, and the evaluation spec."""
    qrels = reduce(lambda a, b: a.unionByName(b), [
        SJ.read_qrels(spark, s["qrels"], s["fmt"], validate=True)
        .select(F.lit(s["name"]).alias("eval_set"), "qid", "pid", "rel") for s in sets])
    spec = [(s["name"], m, k) for s in sets for m, k in (DEV if s["kind"] == "dev" else EVAL)]
    return qrels, spec


def load_queries(spark: SparkSession, sets: list[dict], qrels: DataFrame) -> DataFrame:
    """(eval_set, qid, text): each set's queries that its judgments mention."""
    parts = [ST.read_id_text_tsv(spark, s["queries"], "qid", "text")
             .select(F.lit(s["name"]).alias("eval_set"), "qid", "text") for s in sets]
    judged = qrels.select("eval_set", "qid").distinct()
    return reduce(lambda a, b: a.unionByName(b), parts).join(judged, ["eval_set", "qid"], "left_semi")


def write_runs(run: DataFrame, out: str, system: str, sets: list[dict]) -> DataFrame:
    for s in sets:
        SR.write_run(run.where(F.col("eval_set") == s["name"]).drop("eval_set"),
                     f"{out}/runs/{system}/{s['name']}")
    return reduce(lambda a, b: a.unionByName(b), [
        SR.read_run(run.sparkSession, f"{out}/runs/{system}/{s['name']}")
        .select(F.lit(s["name"]).alias("eval_set"), "qid", "pid", "rank") for s in sets])


class Loaded:
    """Row counts of loaded tables, taken in passing by the jobs that read them."""

    def __init__(self):
        self.seen: dict[str, Observation] = {}

    def observe(self, **tables: DataFrame) -> list[DataFrame]:
        """The tables, each with a count that its first complete read fills in."""
        out = []
        for name, df in tables.items():
            self.seen[name] = Observation(name)
            out.append(df.observe(self.seen[name], F.count(F.lit(1)).alias("rows")))
        return out

    def report(self, wait: float = 30.0) -> None:
        """Print the counts; call after the jobs. They arrive shortly after a job's end; one that does not is left out."""
        end = time.monotonic() + wait
        for name, seen in self.seen.items():
            while not seen._jo.future().isCompleted() and time.monotonic() < end:
                time.sleep(0.02)
            if seen._jo.future().isCompleted():
                print(json.dumps({"loaded": name, "rows": seen.get["rows"]}))
        self.seen.clear()


def report(run: DataFrame, qrels: DataFrame, spec: list, system: str) -> list[dict]:
    rows = SY.evaluate(run, qrels, system, spec).orderBy("eval_set", "metric", "k").collect()
    out = [r.asDict() for r in rows]   # one row per spec cell: a handful
    for r in out:
        print(json.dumps(r))
    return out


def cmd_bm25(spark, a) -> list[dict]:
    counts = Loaded()
    qrels, spec = load_sets(spark, a.set)
    collection = ST.read_id_text_tsv(spark, a.collection, "doc_id", "text")
    inputs = {"collection": collection}
    if a.passages:
        inputs["passages"] = SV.read_vectors(spark, a.passages)
    made_from = {s["name"]: SR.run_manifest({**inputs, "queries": ST.read_id_text_tsv(spark, s["queries"], "qid", "text")},
                                            {"depth": a.depth}) for s in a.set}
    if a.generated:
        for s in a.set:
            saved = f"{a.out}/runs/bm25/{s['name']}"
            if not SR.path_exists(spark, f"{saved}/_SUCCESS"):
                raise SystemExit(f"--generated: no run under --out for {s['name']}")
            was = SR.read_manifest(spark, saved) or {}
            stale = [k for k, v in made_from[s["name"]].items() if k in was and was[k] != v]
            if stale:
                raise SystemExit(f"--generated: the run for {s['name']} was made from another {', '.join(stale)}")
        qrels, = counts.observe(judgments=qrels)
        run = reduce(lambda x, y: x.unionByName(y), [
            SR.read_run(spark, f"{a.out}/runs/bm25/{s['name']}")
            .select(F.lit(s["name"]).alias("eval_set"), "qid", "pid", "rank") for s in a.set])
    else:
        docs = collection
        if a.passages:  # keep passages that have a vector, as the vector systems see them
            docs = FL.subset_by_ids(docs, inputs["passages"], "doc_id", "id")
        docs, queries, judged = counts.observe(passages=docs, queries=load_queries(spark, a.set, qrels), judgments=qrels)
        idx = IX.TextIndex.build(docs)
        run = write_runs(idx.search(queries, k=a.depth, extra_keys=["eval_set"]), a.out, "bm25", a.set)
        for s in a.set:
            SR.write_manifest(spark, f"{a.out}/runs/bm25/{s['name']}", made_from[s["name"]])
        qrels = judged
    out = report(run, qrels, spec, "bm25")
    counts.report()
    return out


def _query_vectors(spark, a, qrels) -> DataFrame:
    qv = SV.read_vectors(spark, a.query_vectors).select(F.col("id").alias("qid"), "embedding")
    return FL.subset_by_ids(qv, qrels, "qid")


def cmd_ann(spark, a) -> list[dict]:
    """Search a trained tree (the default) to a stated recall, or flat cells (``--train pivots|kmeans``) by ``--nprobe``."""
    given = {n: v for n in ("cells", "train", "iters", "assign_k") if (v := getattr(a, n)) is not None}
    exists = bool(a.index) and SR.path_exists(spark, f"{a.index}/params/_SUCCESS")
    if exists and given:
        raise SystemExit(f"--index holds an index already; it can't be built anew with --{', --'.join(sorted(given))}")
    flat = SR.path_exists(spark, f"{a.index}/centroids") if exists else given.get("train", "tree") != "tree"
    if any(isinstance(v, int) and v <= 0 for v in [*given.values(), a.nprobe or 1, a.depth]):
        raise SystemExit("--cells, --iters, --assign-k, --nprobe and --depth must be positive")
    if flat and a.recall is not None or not flat and any(n in given for n in ("iters", "assign_k")):
        raise SystemExit("--recall is for trees, --iters and --assign-k are for flat cells")
    recall = 0.95 if a.recall is None else a.recall
    if not 0 < recall <= 1:
        raise SystemExit("--recall must be above 0 and at most 1")
    counts = Loaded()
    qrels, spec = load_sets(spark, a.set)
    if exists:
        idx = AN.VectorIndex.load(spark, a.index) if flat else VT.VectorTree.load(spark, a.index)
    else:
        passages, = counts.observe(vectors=SV.read_vectors(spark, a.passages))
        if flat:
            idx = AN.VectorIndex.build(passages, given.get("cells"), train=given["train"], iters=given.get("iters", 20),
                                       assign_k=given.get("assign_k", 1), path=a.index)
            if a.index:
                idx.save(a.index)
        else:
            idx = VT.VectorTree.build(passages, a.index, given.get("cells"),
                                      calibrate=((a.depth, recall),) if recall < 1 and a.nprobe is None else ())
    queries, judged = counts.observe(query_vectors=_query_vectors(spark, a, qrels), judgments=qrels)
    run = idx.search(queries, a.depth, a.nprobe or 4) if flat else idx.search(queries, a.depth, recall, a.nprobe)
    run = run.join(qrels.select("eval_set", "qid").distinct(), "qid")
    out = report(write_runs(run, a.out, "ann", a.set), judged, spec, "ann")
    counts.report()
    return out


def cmd_rerank(spark, a) -> list[dict]:
    if not 100 <= a.top <= 1000:
        raise SystemExit("--top must be between 100 and 1000")
    qrels, spec = load_sets(spark, a.set)
    base = reduce(lambda x, y: x.unionByName(y), [
        SR.read_run(spark, f"{a.runs}/{s['name']}").select(
            F.struct(F.lit(s["name"]).alias("eval_set"), F.col("qid")).alias("qid"), "pid", "rank")
        for s in a.set])
    counts = Loaded()
    base, judged = counts.observe(results=base, judgments=qrels)
    qv = (_query_vectors(spark, a, qrels).join(qrels.select("eval_set", "qid").distinct(), "qid")
          .select(F.struct("eval_set", "qid").alias("qid"), "embedding"))
    out = RR.rerank(base, qv, SV.read_vectors(spark, a.passages), a.top)
    run = out.select(F.col("qid.eval_set").alias("eval_set"), F.col("qid.qid").alias("qid"),
                     "pid", "rank", "score")
    reported = report(write_runs(run, a.out, "cascade", a.set), judged, spec, "cascade")
    counts.report()
    return reported


def build_parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="quarry.cli", description=__doc__.split("\n\n")[0])
    p.add_argument("--master", default=None)
    sub = p.add_subparsers(dest="cmd", required=True)

    def common(sp):
        sp.add_argument("--set", type=parse_set, action="append", required=True)
        sp.add_argument("--out", required=True)
        sp.add_argument("--depth", type=int, default=1000)

    b = sub.add_parser("bm25")
    common(b)
    b.add_argument("--collection", required=True)
    b.add_argument("--passages", help="optional: keep only passages with a vector here")
    b.add_argument("--generated", action="store_true", help="reuse runs already under --out")

    n = sub.add_parser("ann")
    common(n)
    n.add_argument("--passages", required=True)
    n.add_argument("--query-vectors", required=True)
    n.add_argument("--cells", type=int, help="default: about the square root of the number of passages")
    n.add_argument("--nprobe", type=int, help="cells read; for flat cells 4 by default, a tree follows --recall")
    n.add_argument("--recall", type=float, help="share of the true neighbours that a tree finds; 1 is exact; default 0.95")
    n.add_argument("--assign-k", type=int, help="cells that hold a passage; default 1")
    n.add_argument("--train", choices=["tree", "pivots", "kmeans"], help="default tree")
    n.add_argument("--iters", type=int, help="k-means iterations; default 20")
    n.add_argument("--index", help="save the index here, or reuse it if present (then without build parameters)")

    r = sub.add_parser("rerank")
    common(r)
    r.add_argument("--passages", required=True)
    r.add_argument("--query-vectors", required=True)
    r.add_argument("--runs", required=True, help="keyword runs, one folder per set")
    r.add_argument("--top", type=int, default=1000)
    return p


def main(argv=None, spark: SparkSession | None = None) -> list[dict]:
    a = build_parser().parse_args(argv)
    spark = spark or get_session(a.master, app=f"quarry-{a.cmd}")
    return {"bm25": cmd_bm25, "ann": cmd_ann, "rerank": cmd_rerank}[a.cmd](spark, a)


if __name__ == "__main__":
    main()
