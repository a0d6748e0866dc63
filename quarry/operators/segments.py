"""A text index that grows and shrinks: segments, tombstones and compaction.

A segmented index is a folder:

* ``segments/<seq>``: the term counts and document lengths of one batch of
  documents, in the layout of ``TextIndex``;
* ``tombstones/<seq>``: ids that are gone from every segment before ``seq``;
* ``terms/<seq>`` and ``sums/<seq>``: what the step changed: document
  frequencies of terms, number of documents and total length, negative for
  documents that went. Their sums are the index's, so no step recounts what it
  does not touch;
* ``log/<seq>``: one row for each finished step, written last. A step that
  fails leaves nothing that readers use.

``add`` replaces documents of the same id. A search asks each segment for its
k best with the merged frequencies and lengths, inside the segment's buckets,
and merges those; a document lives in one segment only. ``compact`` writes the
living documents' counts as one segment. Documents need an integer id; rows
without one are an error, as is an id that a batch holds twice.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions import text as T
from quarry.operators.index import TextIndex, _bucketed_table, _stats_row
from quarry.operators.search import bm25_search_counts, topk
from quarry.session import materialize
from quarry.sources.runs import path_exists


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


@dataclass
class SegmentedIndex:
    spark: SparkSession
    path: str
    k1: float = T.BM25_K1
    b: float = T.BM25_B
    avg_mode: str = "floor"
    steps: list = field(default_factory=list)

    def __post_init__(self):
        if path_exists(self.spark, f"{self.path}/log"):
            self.steps = self.spark.read.parquet(f"{self.path}/log/*").orderBy("seq").collect()    # one row a step

    # ---------------------------------------------------------------- what the steps left

    def _seq(self) -> int:
        return max([s.seq for s in self.steps], default=0) + 1

    def _done(self, seq: int, kind: str, n_buckets: int = 0, base: int = 0) -> None:
        row = self.spark.createDataFrame([(seq, kind, n_buckets, base)], "seq int, kind string, n_buckets int, base int")
        row.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/log/{seq}")
        self.steps = sorted([*self.steps, row.first()], key=lambda s: s.seq)

    def _base(self) -> int:
        """The last compaction; what came before it is no longer read."""
        return max([s.seq for s in self.steps if s.kind == "compact"], default=0)

    def _live_steps(self, *kinds: str) -> list:
        return [s for s in self.steps if s.seq >= self._base() and s.kind in kinds]

    def _tombstones(self, after: int) -> DataFrame | None:
        """Ids gone from a segment written at step ``after``."""
        gone = [s for s in self._live_steps("add", "delete") if s.seq > after]
        return _union([self.spark.read.parquet(f"{self.path}/tombstones/{s.seq}") for s in gone]).distinct() if gone else None

    def _living(self, rows: DataFrame, seq: int) -> DataFrame:
        gone = self._tombstones(seq)
        return rows if gone is None else rows.join(gone, "doc_id", "left_anti")

    def _segments(self) -> list[tuple[int, DataFrame]]:
        """(step, term counts of the living documents) of each segment."""
        return [(s.seq, self._living(_bucketed_table(self.spark, f"{self.path}/segments/{s.seq}", s.n_buckets), s.seq))
                for s in self._live_steps("add", "compact")]

    def documents(self) -> DataFrame:
        """(doc_id, doc_len) of the living documents."""
        some = self._live_steps("add", "compact")
        if not some:
            return self.spark.createDataFrame([], "doc_id bigint, doc_len bigint")
        return _union([self._living(self.spark.read.parquet(f"{self.path}/segments/{s.seq}/doc_lengths"), s.seq)
                       for s in some])

    def doc_freq(self) -> DataFrame:
        """(term, df): sums of what each step changed."""
        some = self._live_steps("add", "delete", "compact")
        if not some:
            return self.spark.createDataFrame([], "term string, df bigint")
        return _union([self.spark.read.parquet(f"{self.path}/terms/{s.seq}") for s in some]) \
            .groupBy("term").agg(F.sum("df").alias("df")).filter("df > 0")

    def stats(self) -> DataFrame:
        """One row (n_docs, total_len, avg_len)."""
        some = self._live_steps("add", "delete", "compact")
        n, total = _union([self.spark.read.parquet(f"{self.path}/sums/{s.seq}") for s in some]).agg(
            F.sum("n_docs"), F.sum("total_len")).first() if some else (0, 0)
        return _stats_row(self.spark, int(n), int(total), self.avg_mode)

    # ---------------------------------------------------------------- steps

    def _write_changes(self, seq: int, added: TextIndex | None, gone: DataFrame) -> None:
        """Tombstones of ``gone`` (doc_id), and frequencies and sums as the step leaves them changed."""
        gone = materialize(gone.select(F.col("doc_id").cast("bigint").alias("doc_id")).distinct(), "gone")
        old = [rows.join(gone, "doc_id", "left_semi") for _, rows in self._segments()]
        terms = [o.groupBy("term").agg((-F.count(F.lit(1))).alias("df")) for o in old]
        went = self.documents().join(gone, "doc_id", "left_semi")
        sums = [went.agg((-F.count(F.lit(1))).alias("n_docs"), (-F.coalesce(F.sum("doc_len"), F.lit(0))).alias("total_len"))]
        if added is not None:
            terms.append(added.tf.groupBy("term").agg(F.count(F.lit(1)).alias("df")))
            sums.append(added.stats.select("n_docs", "total_len"))
        changed = _union(terms) if terms else self.spark.createDataFrame([], "term string, df bigint")
        changed.groupBy("term").agg(F.sum("df").alias("df")).filter("df <> 0") \
            .write.mode("overwrite").parquet(f"{self.path}/terms/{seq}")
        _union(sums).agg(F.sum("n_docs").alias("n_docs"), F.sum("total_len").alias("total_len")) \
            .write.mode("overwrite").parquet(f"{self.path}/sums/{seq}")
        gone.write.mode("overwrite").parquet(f"{self.path}/tombstones/{seq}")

    def add(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> None:
        """Index ``docs`` as a new segment, in place of earlier documents of their ids."""
        docs = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
        once = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("doc_id is null or n > 1")
        if not once.isEmpty():
            raise ValueError("documents of a batch need ids, each once")
        seq = self._seq()
        where = f"{self.path}/segments/{seq}"
        index = TextIndex.build(docs, path=where, k1=self.k1, b=self.b, avg_mode=self.avg_mode)
        index.doc_lengths.write.mode("overwrite").parquet(f"{where}/doc_lengths")
        self._write_changes(seq, index, docs.select("doc_id"))
        self._done(seq, "add", index.params["n_buckets"])

    def delete(self, ids: DataFrame, id_col: str = "doc_id") -> None:
        """Remove the documents of ``ids``; ids that no living document has change nothing."""
        seq = self._seq()
        self._write_changes(seq, None, ids.select(F.col(id_col).alias("doc_id")))
        self._done(seq, "delete")

    def compact(self) -> None:
        """Write the living documents as one segment; earlier steps are read no more."""
        from quarry.operators.index import _write_counts
        from quarry.session import default_buckets

        seq, segments = self._seq(), self._segments()
        if not segments:
            return
        rows = _union([r.select("term", "doc_id", "doc_len", "tf") for _, r in segments])
        n = default_buckets(rows)
        where = f"{self.path}/segments/{seq}"
        tf = _write_counts(rows, where, n, 16)
        self.documents().write.mode("overwrite").parquet(f"{where}/doc_lengths")
        tf.groupBy("term").agg(F.count(F.lit(1)).alias("df")).write.mode("overwrite").parquet(f"{self.path}/terms/{seq}")
        self.spark.read.parquet(f"{where}/doc_lengths").agg(
            F.count(F.lit(1)).alias("n_docs"), F.coalesce(F.sum("doc_len"), F.lit(0)).alias("total_len")) \
            .write.mode("overwrite").parquet(f"{self.path}/sums/{seq}")
        self._done(seq, "compact", n)

    # ---------------------------------------------------------------- search

    def search(self, queries: DataFrame, k: int = 1000, mode: str = "or") -> DataFrame:
        """Run (qid, pid, rank, score, score_q), as of one index of the living documents."""
        dfreq, stats = materialize(self.doc_freq(), "merged-terms"), self.stats()
        runs = [bm25_search_counts(rows, dfreq, stats, queries, k=k, mode=mode, k1=self.k1, b=self.b, term_buckets=16)
                for _, rows in self._segments()]
        if not runs:
            empty = self.spark.createDataFrame([], "term string, doc_id bigint, doc_len bigint, tf bigint")
            runs = [bm25_search_counts(empty, dfreq, stats, queries, k=k, mode=mode, k1=self.k1, b=self.b)]
        order = [F.desc("score_q"), F.asc("pid")]
        return topk(_union(runs).drop("rank"), k, "qid", order).select("qid", "pid", "rank", "score", "score_q")
