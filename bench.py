"""Headline timings: prints one JSON line.

Runs the workload's stages at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1)
on ``local[$BENCH_CPUS]``. Every stage is forced to completion with the
``noop`` sink (the whole plan runs, nothing is collected). Parameters follow
the studied workload: top-1000 keyword search, k = 10/100 vector search,
rerank depth 100, evaluation matrix of three systems.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from quarry.operators import index as IX  # noqa: E402
from quarry.operators import knn as KN  # noqa: E402
from quarry.operators import rerank as RR  # noqa: E402
from quarry.operators import vector_tree as VT  # noqa: E402
from quarry.plans import systems as PL  # noqa: E402
from quarry.session import get_session, scratch_path  # noqa: E402
from quarry.sources import tables as TB  # noqa: E402


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    extra = {"spark.driver.memory": "16g"}
    if os.environ.get("BENCH_EVENT_LOG_DIR"):
        # stage/task times without the UI: Spark's event log in a scratch folder
        extra.update({"spark.eventLog.enabled": "true",
                      "spark.eventLog.dir": os.environ["BENCH_EVENT_LOG_DIR"]})
    shuffle = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", 2 * cpus))
    spark = get_session(f"local[{cpus}]", app="quarry-bench", shuffle_partitions=shuffle,
                        extra=extra)
    times: dict[str, float] = {}

    def timed(name, fn):
        t0 = time.time()
        fn()
        times[name] = round(time.time() - t0, 3)

    docs = TB.passages(spark, sf_dir)
    queries = TB.keyword_queries(spark, sf_dir)
    vecs = TB.vectors(spark, sf_dir)
    qvecs = PL.query_vectors(spark, sf_dir)
    # warm-up: JVM, Python workers, file listing (not timed)
    run(IX.doc_lengths(docs))

    timed("parse_term_freq", lambda: run(IX.term_freq(docs)))
    index_path = scratch_path(spark, "bench-index")
    timed("index_build", lambda: IX.TextIndex.build(docs, path=index_path).save(index_path))
    idx = IX.TextIndex.load(spark, index_path)
    timed("bm25_or_top1000", lambda: run(idx.search(queries, k=1000, mode="or")))
    timed("bm25_and_top1000", lambda: run(idx.search(queries, k=1000, mode="and")))
    timed("knn_exact_k100", lambda: run(KN.knn_exact(vecs, qvecs, 100)))
    vpath = scratch_path(spark, "bench-ann")
    # trained cells, and as many of them read as find 95 % of the neighbours
    timed("ann_build", lambda: VT.VectorTree.build(vecs, vpath, calibrate=((100, 0.95),)))
    vidx = VT.VectorTree.load(spark, vpath)
    timed("ann_search_k100", lambda: run(vidx.search(qvecs, 100, recall=0.95)))
    bm25_run = idx.search(queries, k=1000)
    timed("rerank_top100", lambda: run(RR.rerank(bm25_run, qvecs, vecs, 100, on_missing="drop")))
    # judgments are the evaluation's input (stand-ins for given qrels files):
    # built and saved once, timed on their own
    holder = {}
    timed("judgment_sets", lambda: holder.setdefault("q", PL.saved_judgment_sets(spark, sf_dir)))
    timed("eval_matrix", lambda: run(PL.eval_matrix(spark, sf_dir, qrels=holder["q"])))

    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "total_stage_time", "value": total, "unit": "sec",
                      "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", ""),
                      "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
