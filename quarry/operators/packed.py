"""Term counts with one row for each document: (doc_id, doc_len, terms, tfs).

A scratch index is written this way: a row for each document instead of one
for each of its terms. Terms and counts are two strings of words, each ended
by a space, so Spark moves whole strings and never single terms. A search of
few terms looks them up in Arrow batches, so only the postings that it asks
for become rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.session import ROW_BYTES, map_bounded

SCHEMA = "doc_id bigint, doc_len bigint, terms string, tfs string"
PACK_BYTES = 2 << 20      # of texts that are split into terms at a time inside a task, and one text more
WANTED_BYTES = 8 << 20    # of terms that are looked up inside tasks; beyond, a join does it
SPACE = 32
# every byte but ASCII letters and digits separates tokens, as T.TOKEN_PATTERN has it
SEPARATE = bytes(c if chr(c).isalnum() and c < 128 else SPACE for c in range(256))


def _bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, end of each row in them) of a string column, a null as an empty string."""
    column = column.fill_null("") if column.null_count else column
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(0, np.int64)
    _, offsets, values = column.cast(pa.binary()).buffers()
    at = np.frombuffer(offsets, np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    whole = np.frombuffer(values, np.uint8) if values is not None else np.zeros(0, np.uint8)
    return whole[at[0]:at[-1]], at[1:] - at[0]


def _strings(ends: np.ndarray, values) -> pa.StringArray:
    """Strings that lie one behind the other in ``values``."""
    return pa.StringArray.from_buffers(len(ends), pa.py_buffer(np.concatenate([[0], ends]).astype(np.int32)), pa.py_buffer(values))


def _ended(words: pa.Array) -> pa.Array:
    return pc.binary_join_element_wise(words, "", " ")


def _joined(words: pa.StringArray, n_words: np.ndarray) -> pa.StringArray:
    """A string for each row, of the next ``n_words`` of ``words``."""
    values, ends = _bytes(words)
    return _strings(np.concatenate([[0], ends])[np.cumsum(n_words)], values)


def words(column: pa.Array) -> tuple[pa.StringArray, np.ndarray]:
    """The words of a column of strings of ended words, and the row of each."""
    values, rows = _bytes(column)
    ends = np.flatnonzero(values == SPACE)
    n_words = np.diff(np.searchsorted(ends, rows), prepend=0)
    return _strings(ends - np.arange(len(ends)), values.tobytes().translate(None, b" ")), np.repeat(np.arange(len(column)), n_words)


def _counted(text: pa.Array) -> list[pa.Array]:
    """(doc_len, terms, tfs) of some texts."""
    values, rows = _bytes(text)
    values = values.tobytes().translate(SEPARATE)
    inside = np.frombuffer(values, np.uint8) != SPACE
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    starts = np.concatenate([[0], rows[:-1]])
    starts = starts[starts < len(values)]
    first[starts] = inside[starts]                  # a text's first letter begins a token whatever stands before it
    last = inside.copy()
    last[:-1] &= first[1:] | ~inside[1:]
    first, last = np.flatnonzero(first), np.flatnonzero(last)
    lengths = np.diff(np.searchsorted(first, rows), prepend=0)
    if not len(first):
        return [pa.array(lengths, pa.int64()), pa.array([""] * len(text)), pa.array([""] * len(text))]
    token = _strings(np.cumsum(last - first + 1), values.translate(None, b" ")).dictionary_encode()
    names = token.dictionary
    key = np.repeat(np.arange(len(text)) * len(names), lengths) + token.indices.to_numpy(zero_copy_only=False)
    key.sort()                                      # by text and term
    at = np.flatnonzero(np.diff(key, prepend=-1))
    tfs = np.diff(at, append=len(key))
    doc, name = np.divmod(key[at], len(names))
    held = np.bincount(doc, minlength=len(text))
    count = pa.array(tfs).dictionary_encode()
    return [pa.array(lengths, pa.int64()), _joined(_ended(names).take(pa.array(name)), held),
            _joined(_ended(count.dictionary.cast(pa.string())).take(count.indices), held)]


def pack(docs: DataFrame) -> DataFrame:
    """Packed counts of ``docs(doc_id, text)``, one row for each row, also without terms."""
    def run(batches):
        for batch in batches:
            ends, at = _bytes(batch.column(1))[1], 0
            while at < batch.num_rows:
                before = ends[at - 1] if at else 0
                to = max(at + 1, int(np.searchsorted(ends, before + PACK_BYTES, "right")))
                some = batch.slice(at, to - at)
                yield pa.RecordBatch.from_arrays([some.column(0), *_counted(some.column(1))],
                                                 names=["doc_id", "doc_len", "terms", "tfs"])
                at = to

    return map_bounded(docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")), run, SCHEMA)


def unpack(packed: DataFrame) -> DataFrame:
    """(term, doc_id, doc_len, tf): one row for each posting."""
    term, tf = (F.split(F.rtrim(c), " ").alias(c) for c in ("terms", "tfs"))
    return packed.where("doc_len > 0").select("doc_id", "doc_len", F.inline(F.arrays_zip(term, tf))) \
        .select(F.col("terms").alias("term"), "doc_id", "doc_len", F.col("tfs").cast("bigint").alias("tf"))


def wanted_terms(terms: DataFrame) -> pa.Array | None:
    """The distinct terms of ``terms(term)``, in order, if their bytes are within ``WANTED_BYTES``."""
    some = terms.select("term").where("term is not null").distinct()
    size = some.agg(F.sum(F.octet_length("term") + ROW_BYTES)).first()[0] or 0
    return pa.array(sorted(r["term"] for r in some.collect()), pa.string()) if size <= WANTED_BYTES else None


def found(terms: pa.Array, wanted: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, place among all the words, number of the term) of the words of a column that are ``wanted``."""
    held, row = words(terms)
    number = pc.index_in(held, value_set=wanted)
    at = np.flatnonzero(number.is_valid().to_numpy(zero_copy_only=False))
    return row[at], at, number.fill_null(0).to_numpy(zero_copy_only=False)[at]


def counts_at(tfs: pa.Array, at: np.ndarray) -> pa.Array:
    """The counts at some places among all the words of a column."""
    return words(tfs)[0].take(pa.array(at)).cast(pa.int64())


def document_of(lists: pa.ListArray) -> np.ndarray:
    """The row of each element of a column of lists."""
    return np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))


def term_counts(packed: DataFrame, wanted: pa.Array) -> DataFrame:
    """(t, df): documents that hold the term numbered t; terms that none holds are left out."""
    def run(batches):
        count = np.zeros(len(wanted), np.int64)
        for batch in batches:
            count += np.bincount(found(batch.column(0), wanted)[2], minlength=len(wanted))
        some = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(count[some])], names=["t", "n"])

    return map_bounded(packed.select("terms"), run, "t int, n bigint").groupBy("t").agg(F.sum("n").alias("df"))


def postings_of(packed: DataFrame, wanted: pa.Array) -> DataFrame:
    """(term, doc_id, doc_len, tf) of the wanted terms alone."""
    def run(batches):
        for batch in batches:
            doc, at, t = found(batch.column(2), wanted)
            doc = pa.array(doc)
            yield pa.RecordBatch.from_arrays(
                [wanted.take(pa.array(t)), batch.column(0).take(doc), batch.column(1).take(doc), counts_at(batch.column(3), at)],
                names=["term", "doc_id", "doc_len", "tf"])

    return map_bounded(packed.select("doc_id", "doc_len", "terms", "tfs"), run, "term string, doc_id bigint, doc_len bigint, tf bigint")


def saturated(tf: np.ndarray, doc_len: np.ndarray, avg_len: float | None, k1: float, b: float) -> np.ndarray:
    """``text.bm25_tf``, by its arithmetic in its order."""
    if not avg_len:
        return np.zeros(len(tf))
    tf = tf.astype(np.float64)
    norm = k1 * ((1.0 - b) + b * (doc_len.astype(np.float64) / avg_len))
    return ((k1 + 1.0) * tf) / (norm + tf)


def impacts(idf: np.ndarray, tf: np.ndarray, doc_len: np.ndarray, avg_len: float | None, k1: float, b: float,
            hi: float, levels: int) -> np.ndarray:
    """Quantised weights, by the arithmetic of ``text.bm25_impact`` and ``text.quantize``, in their order."""
    weight = idf * saturated(tf, doc_len, avg_len, k1, b)
    return np.where(weight <= 0, 0, np.where(weight >= hi, levels, np.floor(weight / hi * float(levels)))).astype(np.int64)


BOUND_POSTINGS = 1 << 21      # postings that a task aggregates at a time


def block_extents(packed: DataFrame, block, avg_len: float | None, k1: float, b: float) -> DataFrame:
    """(term, block, part, n): largest saturated frequency and number of postings, aggregated inside tasks of whole blocks."""
    def aggregated(some: list[pa.RecordBatch]) -> list[pa.RecordBatch]:
        held = pa.Table.from_batches(some).group_by(["term", "block"], use_threads=False).aggregate([("part", "max"), ("part", "count")])
        return held.select(["term", "block", "part_max", "part_count"]).rename_columns(["term", "block", "part", "n"]) \
            .combine_chunks().to_batches()

    def run(batches):
        fresh, n = [], 0
        for batch in batches:
            term, doc = words(batch.column(1))
            tf = words(batch.column(2))[0].cast(pa.int64()).to_numpy(zero_copy_only=False)
            length = batch.column(0).to_numpy(zero_copy_only=False)[doc]
            fresh.append(pa.RecordBatch.from_arrays(
                [term, batch.column(3).take(pa.array(doc)), pa.array(saturated(tf, length, avg_len, k1, b))],
                names=["term", "block", "part"]))
            n += len(doc)
            if n >= BOUND_POSTINGS:
                yield from aggregated(fresh)
                fresh, n = [], 0
        if fresh:
            yield from aggregated(fresh)

    rows = packed.select("doc_len", "terms", "tfs", block.alias("block"))
    # documents of a block together: a term's postings there are mostly combined before they are shuffled
    return map_bounded(rows.repartition("block"), run, "term string, block int, part double, n bigint")
