"""Language identification: multinomial naive Bayes over hashed character n-grams.

Lower-cased texts are code point arrays; n-grams of orders 1 to 3 are hashed to
buckets. Training sums bucket counts per language over at most ``SAMPLE_DOCS``
labelled documents in Spark; the matrix of log-probabilities (buckets x
languages) is broadcast, and a document's score is the sum of the rows of its
n-grams, gathered in numpy.

Defined results: null texts and texts without a letter are ``und`` with score
0; without any labelled text every document is; ties go to the language first
in order; repeated rows score alike; other columns are ignored.
"""

from __future__ import annotations


import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import bounded_sample, map_arrow, odd_multipliers, slices

ORDERS = 3
BUCKETS = 1 << 16
SAMPLE_DOCS = 20_000     # labelled documents the model is trained on, at most
SMOOTHING = 0.5
BLOCK = 1 << 18          # code points scored at a time
UNKNOWN = "und"
GRAMS = 1 << 22          # n-grams of a slice scored together, about


def has_letter(text: str | None) -> bool:
    return any(map(str.isalpha, text or ""))


def ngram_buckets(text: str) -> list[np.ndarray]:
    """Bucket of every n-gram of every order, in blocks."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    multipliers = odd_multipliers(ORDERS, 41)
    out = []
    for at in range(0, len(codes), BLOCK):
        block = codes[at:at + BLOCK + ORDERS - 1]
        for n in range(1, ORDERS + 1):
            m = min(BLOCK, len(block) - n + 1)
            if m <= 0:
                continue
            h = np.full(m, n, np.uint64)
            for j in range(n):
                h = (h + block[j:j + m]) * multipliers[j]
                h ^= h >> np.uint64(29)
            out.append(((h * multipliers[0]) >> np.uint64(48)).astype(np.intp))
    return out


def train(labelled: DataFrame, bound: int = SAMPLE_DOCS) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Languages, log prior and log-probabilities (languages x buckets) from (doc_id, text, lang)."""
    labelled = labelled.filter("lang is not null")
    rows = bounded_sample(labelled, "doc_id", bound, labelled.select("doc_id", "lang").count()) \
        .select("lang", F.col("text").cast("string"))

    def run(batches):
        counts: dict[str, np.ndarray] = {}
        for b in slices(batches):
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if has_letter(text):
                    c = counts.setdefault(lang, np.zeros(BUCKETS + 1, np.int64))
                    c[BUCKETS] += 1      # documents
                    for h in ngram_buckets(text):
                        c[:BUCKETS] += np.bincount(h, minlength=BUCKETS)
        for lang, c in counts.items():
            at = np.flatnonzero(c)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at)), pa.array(at.astype(np.int32)),
                                              pa.array(c[at])], names=["lang", "bucket", "n"])

    counted = map_arrow(rows, run, "lang string, bucket int, n bigint") \
        .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()   # languages x buckets at most
    langs = sorted(counted["lang"].unique())
    counts = np.zeros((len(langs), BUCKETS + 1))
    counts[counted["lang"].map({x: i for i, x in enumerate(langs)}).to_numpy(np.intp),
           counted["bucket"].to_numpy()] = counted["n"]
    grams = counts[:, :BUCKETS] + SMOOTHING
    prior = np.log(counts[:, BUCKETS] / max(1.0, counts[:, BUCKETS].sum()))
    return langs, prior, np.log(grams / grams.sum(axis=1, keepdims=True)).astype(np.float32)


def _sparse(texts: list[str], rows: np.ndarray):
    """The texts' n-grams as (row, bucket) entries of a sparse matrix, in row order, in parts of bounded size."""
    row, gram, size = [], [], 0
    for r in rows.tolist():
        for h in ngram_buckets(texts[r]):
            row.append(np.full(len(h), r))
            gram.append(h)
            size += len(h)
            if size >= GRAMS:
                yield np.concatenate(row), np.concatenate(gram)
                row, gram, size = [], [], 0
    if size:
        yield np.concatenate(row), np.concatenate(gram)


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray, np.ndarray]) -> DataFrame:
    """(doc_id, lang_pred, score): most likely language and its posterior probability."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        langs, prior, table = shared.value
        for b in slices(batches):
            texts = b.column(1).to_pylist()
            total = np.tile(prior, (len(texts), 1))
            known = np.array([bool(langs) and has_letter(t) for t in texts], bool)
            for row, gram in _sparse(texts, np.flatnonzero(known)):
                # rows of ones in the columns of their n-grams, times the table
                starts = np.flatnonzero(np.diff(row, prepend=-1))
                for k in range(len(langs)):
                    total[row[starts], k] += np.add.reduceat(table[k][gram], starts, dtype=np.float64)
            best, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
            if langs:
                top = total.argmax(axis=1)
                score = np.where(known, 1 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1), 0.0)
                best = [langs[k] if some else UNKNOWN for k, some in zip(top, known)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(best, pa.string()), pa.array(score, pa.float64())],
                                             names=["doc_id", "lang_pred", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_arrow(docs.select("doc_id", F.col("text").cast("string")), run,
                     f"doc_id {kind}, lang_pred string, score double")


def identify(docs: DataFrame) -> DataFrame:
    """op6: predictions of every document, learnt from those whose crc32(doc_id) mod 4 is not 2."""
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    model = train(docs.filter(~held_out))
    return predict(docs, model).withColumn("held_out", held_out).select("doc_id", "held_out", "lang_pred", "score")
