"""Inverted-index construction over a passage table ``(doc_id, text)``.

Plan shape (what Catalyst gets):

* tokens are exploded once per document row, carrying the document length
  along, so no length join is ever needed;
* term frequency is counted inside each document row, in Arrow batches, so
  building postings needs no shuffle of tokens at all;
* document frequency is a ``groupBy(term)`` (partial + final, so a term that
  occurs in every document is still combined map-side) joined back on
  ``term``; a hot term is handled by AQE's skew-join split, never by a window
  over the whole term;
* collection size and mean length are scalar subqueries, not cross joins;
* a saved index stores per-document term counts, partitioned by document,
  and weights postings at query time (see ``TextIndex``).
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from quarry.functions import text as T
from quarry.operators import packed as PK
from quarry.operators.packed import SEPARATE
from quarry.session import bounded_broadcast, default_buckets, map_bounded, scratch_path

BUCKET_BYTES = 32 << 20   # of texts in a bucket of an index, about: the memory of a task does not follow the input
COUNT_ROWS = 256          # documents whose terms are Python objects at a time inside a task


def doc_tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, tokens) with the document tokenizer applied."""
    return docs.select(F.col(id_col).alias("doc_id"), T.tokens(text_col).alias("tokens"))


def token_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, pos, token): every token of every document, 1-based position."""
    return (doc_tokens(docs, id_col, text_col)
            .select("doc_id", F.posexplode_outer("tokens").alias("pos", "token"))
            .where(F.col("token").isNotNull())
            .select("doc_id", (F.col("pos") + 1).cast("bigint").alias("pos"), "token"))


def doc_lengths(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, doc_len): token count with repeats; 0 for a null text."""
    return docs.select(F.col(id_col).alias("doc_id"),
                       F.coalesce(F.size(T.tokens(text_col)), F.lit(0)).cast("bigint").alias("doc_len"))


def lengths_from_counts(tf: DataFrame, docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(doc_id, doc_len) from per-document term counts -- no second tokenizing pass.

    Documents with tokens carry their length on every count row; documents
    without any token (absent from ``tf``) get length 0 from an id-only
    anti join.
    """
    have = tf.select("doc_id", "doc_len").dropDuplicates(["doc_id"])
    ids = docs.select(F.col(id_col).alias("doc_id"))
    empty = ids.join(have.select("doc_id"), "doc_id", "left_anti") \
        .select("doc_id", F.lit(0).cast("bigint").alias("doc_len"))
    return have.unionByName(empty)


def term_freq(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              keep_len: bool = False) -> DataFrame:
    """(term, doc_id, tf[, doc_len]) -- one row per distinct term of a document.

    Counted inside each document row, so no shuffle is needed whatever the
    source layout.
    """
    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, COUNT_ROWS):
                some = batch.slice(at, COUNT_ROWS)
                terms, tfs, held, lengths = [], [], [], []
                for text in some.column(1).cast(pa.binary()).to_pylist():
                    tokens = text.translate(SEPARATE).split() if text else []
                    count = Counter(tokens)
                    terms += count.keys()
                    tfs += count.values()
                    held.append(len(count))
                    lengths.append(len(tokens))
                ids = some.column(0).take(pa.array(np.repeat(np.arange(some.num_rows), held)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(terms, pa.binary()).cast(pa.string()), ids, pa.array(np.repeat(np.array(lengths, np.int64), held)),
                     pa.array(tfs, pa.int64())], names=["term", "doc_id", "doc_len", "tf"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    out = map_bounded(rows, run, StructType([StructField("term", StringType()), rows.schema["doc_id"],
                                             StructField("doc_len", LongType()), StructField("tf", LongType())]))
    return out if keep_len else out.drop("doc_len")


def doc_freq(tf: DataFrame) -> DataFrame:
    """(term, df): number of documents containing the term."""
    return tf.groupBy("term").agg(F.count(F.lit(1)).alias("df"))


def collection_stats(lengths: DataFrame, avg_mode: str = "floor") -> DataFrame:
    """One row (n_docs, total_len, avg_len).

    ``avg_mode='floor'`` truncates the mean to an integer (the studied
    system's rule); ``'exact'`` keeps the real mean.
    """
    totals = lengths.agg(F.count(F.lit(1)).cast("bigint").alias("n_docs"),
                         F.coalesce(F.sum("doc_len"), F.lit(0)).cast("bigint").alias("total_len"))
    return totals.withColumn("avg_len", T.mean_length("total_len", "n_docs", avg_mode))


def vocabulary(tf: DataFrame) -> DataFrame:
    """Distinct terms in byte order: a global sort by ranges, so a written copy is sorted across its files."""
    return tf.select("term").distinct().orderBy("term")


def with_impacts(tf: DataFrame, dfreq: DataFrame, n_docs, avg_len,
                 k1: float = T.BM25_K1, b: float = T.BM25_B) -> DataFrame:
    """(term, doc_id, tf, df, doc_len, impact, impact_q): weights of (term, doc) rows.

    ``tf`` (term, doc_id, doc_len, tf), ``dfreq`` (term, df); ``n_docs`` and
    ``avg_len`` are scalar columns. The one place BM25 weights are computed,
    at index time (``build_postings``) or at query time (``TextIndex.search``).
    """
    impact = T.bm25_impact("tf", "df", "doc_len", n_docs, avg_len, k1, b)
    return (tf.join(dfreq.select("term", "df"), "term")
            .withColumn("impact", impact)
            .withColumn("impact_q", T.quantize("impact"))
            .select("term", "doc_id", "tf", "df", "doc_len", "impact", "impact_q"))


def build_postings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   k1: float = T.BM25_K1, b: float = T.BM25_B,
                   avg_mode: str = "floor", tf: DataFrame | None = None) -> DataFrame:
    """(term, doc_id, tf, df, doc_len, impact, impact_q) for every posting.

    ``tf`` (term, doc_id, doc_len, tf) may be given pre-computed -- e.g. a
    written copy, so its consumers (the postings themselves, document
    frequency, token total) read it instead of re-tokenizing.
    """
    tf = tf if tf is not None else term_freq(docs, id_col, text_col, keep_len=True)
    # N counts every document (also token-less ones) from the id column alone
    n_docs = docs.agg(F.count(F.lit(1))).scalar()
    total = tf.agg(F.coalesce(F.sum("tf"), F.lit(0))).scalar()
    return with_impacts(tf, doc_freq(tf), n_docs, T.mean_length(total, n_docs, avg_mode), k1, b)


def lexicon(postings: DataFrame) -> DataFrame:
    """(term, df, cf): documents that hold the term, and its occurrences in all."""
    return postings.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").cast("bigint").alias("cf"))


def posting_profile(postings: DataFrame) -> DataFrame:
    """(term, n_postings, first_doc, last_doc, max_tf): extent of each term's posting list."""
    return postings.groupBy("term").agg(F.count(F.lit(1)).alias("n_postings"), F.min("doc_id").alias("first_doc"),
                                        F.max("doc_id").alias("last_doc"), F.max("tf").cast("bigint").alias("max_tf"))


@dataclass
class TextIndex:
    """Keyword index: per-document term counts, document frequencies, lengths, stats.

    The stored unit is (term, doc_id, doc_len, tf), partitioned by document.
    BM25 weights depend on the term only through ``df``, so a search joins
    the batch's query terms with their ``df`` (a small table) and weights the
    matched rows there and then -- the same expression ``build_postings``
    uses, hence the same quantised impacts. Building the index therefore
    never moves the postings to their terms: no postings-sized shuffle on
    ``term``, which at a large vocabulary could not be avoided by a
    broadcast. ``postings`` still gives the fully weighted table.
    """

    tf: DataFrame            # (term, doc_id, doc_len, tf[, term_bucket]), by document
    dfreq: DataFrame         # (term, df[, cf])
    doc_lengths: DataFrame   # (doc_id, doc_len)
    stats: DataFrame         # (n_docs, total_len, avg_len)
    params: dict
    packed: DataFrame | None = None   # the counts with one row for each document, if no id comes twice
    known: dict = field(default_factory=dict)   # document frequencies of the last batch looked up in ``packed``

    @classmethod
    def build(cls, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              k1: float = T.BM25_K1, b: float = T.BM25_B, avg_mode: str = "floor",
              persist_tf: bool = True, path: str | None = None,
              n_buckets: int | None = None, term_buckets: int | None = None) -> "TextIndex":
        """Index ``docs``.

        With ``persist_tf`` the per-document term counts are written once: at
        ``path`` in the saved-index layout (bucketed on ``doc_id``, split by
        term bucket, 16 of them by default) -- a later ``save(path)`` then
        keeps them instead of writing them again -- else below the shared
        checkpoint folder with one row for each document (``packed``),
        bucketed on ``doc_id``, since one batch reads it whole. One tokenizing
        pass; the lineage starts there.
        """
        spark = docs.sparkSession
        params = {"k1": k1, "b": b, "avg_mode": avg_mode}
        if not persist_tf:
            tf = term_freq(docs, id_col, text_col, keep_len=True)
            lengths = lengths_from_counts(tf, docs, id_col)
            return cls(tf, doc_freq(tf), lengths, collection_stats(lengths, avg_mode), params)
        size = docs.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length(F.col(text_col).cast("string"))).alias("bytes")).first()
        n = n_buckets or default_buckets(docs, size.bytes or 0, BUCKET_BYTES)
        if path is None:
            return cls._packed(docs, id_col, text_col, n, size.n, params)
        # the exchange carries whole documents, not their many more terms: counted after
        # it, the rows already lie in the buckets they are written to
        placed = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).repartition(n, "doc_id")
        tf = term_freq(placed, keep_len=True)
        term_buckets = term_buckets or 16
        tf = _write_counts(tf, path, n, term_buckets, placed=True)
        params.update({"n_buckets": n, "term_buckets": term_buckets, "path": path})
        # one row, computed once while the counts are written: every search
        # then reads a local relation instead of re-deriving it
        stats = _stats_row(spark, size.n,
                           tf.agg(F.coalesce(F.sum("tf"), F.lit(0))).first()[0], avg_mode)
        return cls(tf, doc_freq(tf), lengths_from_counts(tf, docs, id_col), stats, params)

    @classmethod
    def _packed(cls, docs: DataFrame, id_col: str, text_col: str, n: int, n_docs: int, params: dict) -> "TextIndex":
        """An index in scratch, with one row for each document."""
        spark = docs.sparkSession
        where = scratch_path(spark, "index")
        placed = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text")).repartition(n, "doc_id")
        PK.pack(placed).write.bucketBy(n, "doc_id").option("path", f"{where}/documents").saveAsTable(_table_name(where))
        packed = spark.table(_table_name(where))
        seen = packed.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.sum("doc_len").alias("l")) \
            .agg(F.max("n").alias("most"), F.coalesce(F.sum("l"), F.lit(0)).alias("total")).first()
        stats = _stats_row(spark, n_docs, seen.total, params["avg_mode"])
        tf = PK.unpack(packed)
        # rows of an id that repeats are summed by an aggregate over the postings
        return cls(tf, doc_freq(tf), lengths_from_counts(packed.where("doc_len > 0"), docs, id_col), stats,
                   {**params, "n_buckets": n}, packed if (seen.most or 1) == 1 else None)

    def frequencies(self, terms: DataFrame) -> DataFrame:
        """(term, df) of those of ``terms(term)`` that a document holds."""
        wanted = PK.wanted_terms(terms) if self.packed is not None else None
        if wanted is None:
            if self.params.get("loaded"):
                return self.dfreq.select("term", "df").join(bounded_broadcast(terms.select("term").distinct()), "term")
            return doc_freq(self.postings_of(terms))
        if self.known.keys() >= set(wanted.to_pylist()):
            held = [(w, self.known[w]) for w in wanted.to_pylist() if self.known[w]]
            return self.tf.sparkSession.createDataFrame(held, "term string, df bigint")
        names = self.tf.sparkSession.createDataFrame(list(enumerate(wanted.to_pylist())), "t int, term string")
        return PK.term_counts(self.packed, wanted).join(F.broadcast(names), "t").select("term", "df")

    def postings_of(self, terms: DataFrame) -> DataFrame:
        """(term, doc_id, doc_len, tf) of ``terms(term)`` alone."""
        wanted = PK.wanted_terms(terms) if self.packed is not None else None
        if wanted is None:
            return self.tf.select("term", "doc_id", "doc_len", "tf") \
                .join(bounded_broadcast(terms.select("term").distinct()), "term")
        return PK.postings_of(self.packed, wanted)

    @property
    def postings(self) -> DataFrame:
        """(term, doc_id, tf, df, doc_len, impact, impact_q) for every posting."""
        both = self.stats.select(F.struct("n_docs", "avg_len").alias("s")).scalar()
        return with_impacts(self.tf, self.dfreq, both["n_docs"], both["avg_len"],
                            self.params["k1"], self.params["b"])

    def lexicon(self) -> DataFrame:
        return lexicon(self.tf)

    def search(self, queries: DataFrame, k: int = 1000, mode: str = "or", **kw) -> DataFrame:
        """BM25 run over this index; weights only the postings of the batch's terms.

        A loaded index looks up their ``df`` in its lexicon; a fresh one counts it for them alone.
        """
        from quarry.operators.search import bm25_search_counts
        dfreq = self.dfreq if self.params.get("loaded") else None
        return bm25_search_counts(self.tf, dfreq, self.stats, queries, k=k, mode=mode,
                                  k1=self.params["k1"], b=self.params["b"],
                                  term_buckets=self.params.get("term_buckets"), packed=self.packed,
                                  known=self.known, **kw)

    def save(self, path: str, n_buckets: int | None = None, term_buckets: int = 16) -> None:
        """Write a document-partitioned index.

        Term counts are bucketed by ``doc_id`` (all rows of a document in one
        bucket, sorted by term, so Parquet row-group statistics on ``term``
        still prune a term lookup) and split into ``term_buckets``
        directories by a hash of the term. A search over the reloaded index
        sums a document's score inside its bucket's task and keeps a
        per-bucket top-k there: the only shuffle is k rows per query per
        bucket, on ``qid``; dynamic partition pruning skips every directory
        no query term falls in. The lexicon carries ``df``, by ranges of terms.
        """
        spark = self.tf.sparkSession
        if self.params.get("saved") == path:     # loaded from, or saved to, this path
            return
        if self.params.get("path") == path:      # counts already written here by build()
            n, term_buckets = self.params["n_buckets"], self.params["term_buckets"]
        else:
            n = n_buckets or self.params.get("n_buckets") or default_buckets(self.tf)
            _write_counts(self.tf, path, n, term_buckets)
        saved = _bucketed_table(spark, path, n)
        # the lexicon is split by the same term bucket: a search's df lookup
        # is pruned to the batch's buckets like the postings scan
        (lexicon(saved).withColumn("term_bucket", T.term_bucket("term", term_buckets))
         .repartitionByRange(max(n, term_buckets), "term_bucket", "term").sortWithinPartitions("term_bucket", "term")
         .write.partitionBy("term_bucket").mode("overwrite").parquet(f"{path}/lexicon"))
        self.doc_lengths.write.mode("overwrite").parquet(f"{path}/doc_lengths")
        # stats from the written lengths: no second tokenizing pass
        collection_stats(spark.read.parquet(f"{path}/doc_lengths"), self.params["avg_mode"]) \
            .write.mode("overwrite").parquet(f"{path}/stats")
        params = {**self.params, "n_buckets": n, "term_buckets": term_buckets, "path": path}
        spark.createDataFrame([(k, str(v)) for k, v in params.items()],
                              "key string, value string").coalesce(1) \
            .write.mode("overwrite").parquet(f"{path}/params")
        self.params["saved"] = path

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "TextIndex":
        """Reload a saved index; term counts come back as a bucketed, partitioned table."""
        params = {r["key"]: r["value"] for r in spark.read.parquet(f"{path}/params").collect()}
        typed = {"k1": float(params.get("k1", T.BM25_K1)), "b": float(params.get("b", T.BM25_B)),
                 "avg_mode": params.get("avg_mode", "floor"),
                 "n_buckets": int(params["n_buckets"]), "term_buckets": int(params["term_buckets"]),
                 "path": path, "saved": path, "loaded": True}
        return cls(_bucketed_table(spark, path, typed["n_buckets"]),
                   spark.read.parquet(f"{path}/lexicon"),
                   spark.read.parquet(f"{path}/doc_lengths"),
                   spark.read.parquet(f"{path}/stats"), typed)

    def saved_lexicon(self, path: str) -> DataFrame:
        return self.tf.sparkSession.read.parquet(f"{path}/lexicon")


def _stats_row(spark: SparkSession, n_docs: int, total: int, avg_mode: str) -> DataFrame:
    """The (n_docs, total_len, avg_len) row; same arithmetic as ``collection_stats``."""
    if avg_mode == "floor":
        avg = float(total // n_docs) if n_docs else None
    elif avg_mode == "exact":
        avg = total / n_docs if n_docs else None
    else:
        raise ValueError(f"avg_mode must be 'floor' or 'exact', got {avg_mode!r}")
    return spark.createDataFrame([(n_docs, total, avg)],
                                 "n_docs BIGINT, total_len BIGINT, avg_len DOUBLE")


_POSTINGS_COLUMNS = "term STRING, doc_id BIGINT, doc_len BIGINT, tf BIGINT"


def _table_name(path: str) -> str:
    import hashlib
    return "quarry_postings_" + hashlib.sha1(path.encode()).hexdigest()[:16]


def _write_counts(tf: DataFrame, path: str, n_buckets: int, term_buckets: int,
                  placed: bool = False, by_term: bool = True) -> DataFrame:
    """Write (term, doc_id, doc_len, tf) in the index layout and return the table.

    Bucketed on ``doc_id`` (one file per bucket per directory: rows are
    hash-partitioned on the bucket key first, unless they are ``placed`` so
    already), sorted by term inside a bucket if ``by_term``, split into
    ``term_buckets`` directories by a hash of the term.
    """
    spark = tf.sparkSession
    spark.sql(f"DROP TABLE IF EXISTS {_table_name(path)}")
    rows = (tf.select("term", "doc_id", "doc_len", "tf")
            .withColumn("term_bucket", T.term_bucket("term", term_buckets)))
    rows = rows if placed else rows.repartition(n_buckets, "doc_id")
    writer = rows.write.partitionBy("term_bucket").bucketBy(n_buckets, "doc_id")
    writer = writer.sortBy("term") if by_term else writer
    writer.mode("overwrite").option("path", f"{path}/postings").saveAsTable(_table_name(path))
    return _bucketed_table(spark, path, n_buckets, by_term)


def _bucketed_table(spark: SparkSession, path: str, n_buckets: int, by_term: bool = True) -> DataFrame:
    """Register the saved postings as a bucketed external table of the session's catalog.

    A definition left from another layout is replaced. The catalog starts an
    external table without partitions, so it is told of those in the folder.
    """
    name = _table_name(path)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} ({_POSTINGS_COLUMNS}, term_bucket INT) "
              f"USING parquet PARTITIONED BY (term_bucket) "
              f"CLUSTERED BY (doc_id) {'SORTED BY (term) ' if by_term else ''}INTO {n_buckets} BUCKETS "
              f"LOCATION '{path}/postings'")
    spark.catalog.recoverPartitions(name)
    return spark.table(name)
