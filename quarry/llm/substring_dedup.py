"""Exact removal of repeated word windows, by super-k-mer partitioning.

Words are runs of characters other than ASCII white space, unchanged. A window
is 13 consecutive words of a document. Words covered by a window whose words
also start in a document with a smaller id are removed; all windows are judged
on the input.

* A window's minimiser is the smallest of its runs of two words in a fixed
  random order. Equal windows have equal minimisers, and neighbouring windows
  mostly share one: such a stretch, a super-k-mer, travels once, as one packed
  string, to its minimiser's bucket. Runs of words that are frequent in the
  corpus come last in the order, so a common phrase is a minimiser only of
  windows that hold nothing rarer. What is frequent is counted over all
  documents in a table of fixed size.
* A packed string holds 2 bytes for each of up to 65,535 frequent words and the
  others in full, so it stands for exactly its words. What a task sends to one
  bucket is compressed together.
* Copies are combined before the shuffle: of equal super-k-mers that a task
  holds (by 128-bit hashes of their words), the one of the smallest id travels
  and the others are decided there, as all their windows are in a smaller
  document. A hot passage sends one string for each task and flush.
* The number of buckets follows the number of windows. A bucket sorts its
  windows, by a hash first and by all words where different windows have equal
  hashes, and takes the smallest id of each. The windows of a bucket that is
  too large for a task are grouped by Spark instead.
* Removed word ranges go back to their document in one join.

Defined results: null and empty texts have no words; the windows of a row
without an id neither remove nor are removed; rows of one id never remove each
other's words, rows equal in id and text have equal results; other columns are
ignored; an empty table gives an empty result. Ids are integers.
"""

from __future__ import annotations

import struct
from collections import Counter
from itertools import compress

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import PerWorker, map_arrow, odd_multipliers, slices, splitmix
from quarry.session import materialize

WINDOW = 13              # words of a window
RUN = 2                  # words of a minimiser
COUNTERS = 1 << 16       # of the frequency table
HEAVY = 8                # a counter so many times above the mean marks frequent runs
CODES = (1 << 16) - 1    # words with a code of their own, at most; the last code marks the others
LONGEST_CODED = 64       # bytes of a word that may have a code
SEEN = 8                 # occurrences in a task's part that make a word a candidate for a code
LONGEST = 100            # windows of a super-k-mer
HELD = 200_000           # super-k-mers that a task combines before it sends them on
WORDS_HELD = 300_000     # words that a worker remembers
PER_BUCKET = 500_000     # windows of a bucket, about
LARGE = 300_000          # super-k-mers of a bucket above which Spark groups its windows
TOP = np.uint64(1 << 63)
HEAD = "<III"            # bytes before compression, super-k-mers, words


def split(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").split() if text else []


class Words(dict):
    """Value of each word met: 48 bits of its hash above its 16-bit code."""

    def __init__(self, coded: list[bytes]):
        super().__init__()
        self.codes = {w: k for k, w in enumerate(coded)}

    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word) & ~CODES | self.codes.get(word, CODES)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > WORDS_HELD:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def run_hashes(values: np.ndarray) -> np.ndarray:
    """Hash of each run of words, whatever their codes."""
    hashes = values & np.uint64(0xFFFFFFFFFFFF0000)
    n = max(0, len(hashes) - RUN + 1)
    out = np.zeros(n, np.uint64)
    for j, m in enumerate(odd_multipliers(RUN, 29)):
        out += hashes[j:j + n] * m
    return splitmix(out)


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Smallest of each ``width`` neighbours, by doubling."""
    out, have = x, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[:len(out) - step], out[step:])
        have += step
    return out


def super_kmers(values: np.ndarray, text: np.ndarray, heavy: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First windows, ends and minimisers of the stretches of windows that share a minimiser, over the words of several
    texts; ``text`` tells them apart."""
    n = len(values) - WINDOW + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    hashes = run_hashes(values)
    order = hashes >> np.uint64(1) | np.where(heavy[hashes % np.uint64(COUNTERS)], TOP, np.uint64(0))
    least = sliding_min(order, WINDOW - RUN + 1)
    whole = text[:n] == text[WINDOW - 1:]
    new = whole.copy()
    new[1:] &= ~whole[:-1] | (least[1:] != least[:-1]) | (text[1:n] != text[:n - 1])
    edges = np.append(np.flatnonzero(new | ~whole), n)
    starts = np.flatnonzero(new)
    ends = edges[np.searchsorted(edges, starts) + 1]
    if len(starts) and (ends - starts).max() > LONGEST:
        parts = -(-(ends - starts) // LONGEST)
        first, ends = np.repeat(starts, parts), np.repeat(ends, parts)
        starts = first + LONGEST * (np.arange(len(first)) - np.repeat(np.cumsum(parts) - parts, parts))
        ends = np.minimum(starts + LONGEST, ends)
    return starts, ends, least[starts]


def ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Indexes ``start, start + 1, ...`` of each stretch, one after the other."""
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))


def _powers(multiplier: int, n: int) -> np.ndarray:
    out = np.full(n, multiplier, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def stretch_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
    """Two 64-bit hashes of the words in each stretch: polynomials, from running sums."""
    out = []
    for m in (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93):
        mixed = splitmix(values ^ np.uint64(m)) * _powers(m, len(values))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed, dtype=np.uint64)])
        back = _powers(pow(m, -1, 1 << 64), len(values) + 1)
        out.append(splitmix((sums[ends] - sums[starts]) * back[starts] + (ends - starts).astype(np.uint64)))
    return out


def _frequencies(docs: DataFrame) -> tuple[list[bytes], np.ndarray, int]:
    """The words that get codes, the mask of frequent runs, both of fixed size, and the number of windows."""
    def run(batches):
        held, table, hashes, windows = Counter(), np.zeros(COUNTERS, np.int64), Words([]), 0

        def emit(words, n, counter):
            return pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), pa.array(counter, pa.int32()),
                                               pa.array(n, pa.int64())], names=["word", "counter", "n"])

        def words_seen():
            some = [(w, n) for w, n in held.items() if n >= SEEN and len(w) <= LONGEST_CODED]
            return emit([w for w, _ in some], [n for _, n in some], [None] * len(some))

        for b in slices(batches):
            texts = [w for w in map(split, b.column(0).to_pylist()) if len(w) >= WINDOW]
            for words in texts:
                held.update(words)
                windows += len(words) - WINDOW + 1
            if texts:                      # runs over the edge of two texts are counted too
                runs = run_hashes(np.concatenate([hashes.of(w) for w in texts]))
                table += np.bincount((runs % np.uint64(COUNTERS)).astype(np.int64), minlength=COUNTERS)
            if len(held) > WORDS_HELD:
                yield words_seen()
                held.clear()
        yield words_seen()
        used = np.flatnonzero(table)
        yield emit([None] * (len(used) + 1), np.append(table[used], windows), np.append(used, -1))

    counted = map_arrow(docs.select("text"), run, "word binary, counter int, n bigint") \
        .groupBy("word", "counter").agg(F.sum("n").alias("n"))
    counted = materialize(counted, "frequencies")
    coded = counted.filter("word is not null").orderBy(F.desc("n"), "word").limit(CODES)
    coded = sorted(bytes(r.word) for r in coded.select("word").collect())
    table, windows = np.zeros(COUNTERS, np.int64), 0
    for r in counted.filter("counter is not null").collect():       # one row for each counter
        if r.counter < 0:
            windows = r.n
        else:
            table[r.counter] = r.n
    return coded, table > HEAVY * max(1.0, table.mean()), windows


ROWS = ["bucket", "strings", "doc", "digest", "first", "end"]
ROWS_SCHEMA = "bucket int, strings binary, doc bigint, digest bigint, first int, end int"


def _rows(bucket, strings, doc=None, digest=None, first=None, end=None) -> pa.RecordBatch:
    nothing = [None] * len(bucket)
    cols = [(bucket, pa.int32()), (strings, pa.binary()), (doc, pa.int64()), (digest, pa.int64()), (first, pa.int32()),
            (end, pa.int32())]
    return pa.RecordBatch.from_arrays([pa.array(nothing if x is None else x, t) for x, t in cols], names=ROWS)


class Cutter:
    """Cuts a task's texts into super-k-mers, combines equal ones and packs what goes to each bucket."""

    def __init__(self, coded: list[bytes], heavy: np.ndarray, buckets: int):
        self.words, self.heavy, self.buckets = Words(coded), heavy, buckets
        self.clear()

    def clear(self) -> None:
        self.parts, self.rare, self.seen = [], [], set()
        self.n_words = self.n_strings = 0

    def add(self, docs: list[tuple[int, int, list[bytes]]]) -> None:
        """Texts (id, hash, words); a text that was added with its id before counts once."""
        fresh = []
        for doc, digest, words in docs:
            if (doc, digest) not in self.seen:
                self.seen.add((doc, digest))
                fresh.append((doc, digest, words))
        if not fresh:
            return
        n = np.array([len(w) for _, _, w in fresh])
        text = np.repeat(np.arange(len(fresh)), n)
        values = np.concatenate([self.words.of(w) for _, _, w in fresh])
        starts, ends, least = super_kmers(values, text, self.heavy)
        ends = ends + WINDOW - 1                               # in words now
        codes = (values & np.uint64(CODES)).astype("<u2")
        at = np.flatnonzero(codes == CODES)
        first = np.cumsum(n) - n
        self.rare += [fresh[t][2][i] for t, i in zip(text[at].tolist(), (at - first[text[at]]).tolist())]
        place = starts - first[text[starts]] if len(starts) else starts
        doc, digest = (np.array([f[k] for f in fresh], np.int64)[text[starts]] for k in (0, 1))
        self.parts.append((codes, at + self.n_words, starts + self.n_words, ends - starts, least, doc, digest, place,
                           *stretch_hashes(values, starts, ends)))
        self.n_words += len(values)
        self.n_strings += len(starts)

    def flush(self):
        """Rows of packed strings by bucket, and of the ranges that are decided here."""
        if not self.n_strings:
            self.clear()
            return
        codes, rare_at, start, size, least, doc, digest, place, h1, h2 = (np.concatenate(c) for c in zip(*self.parts))
        order = np.lexsort((doc, h2, h1))
        new = np.append(True, (h1[order[1:]] != h1[order[:-1]]) | (h2[order[1:]] != h2[order[:-1]]))
        smallest = doc[order[new]][np.cumsum(new) - 1]
        late = np.zeros(len(doc), bool)
        late[order] = doc[order] > smallest
        # ranges of the later copies: neighbours of one text overlap, so they are one range
        i = np.flatnonzero(late)
        if len(i):
            i = i[np.lexsort((place[i], digest[i], doc[i]))]
            a, z = place[i], place[i] + size[i]
            new = np.append(True, (a[1:] > z[:-1]) | (doc[i[1:]] != doc[i[:-1]]) | (digest[i[1:]] != digest[i[:-1]]))
            last = np.append(np.flatnonzero(new)[1:], len(i)) - 1
            j = i[new]
            yield _rows(digest[j] % self.buckets, None, doc[j], digest[j], a[new], z[last])
        i = np.flatnonzero(~late)
        bucket = (least[i] % np.uint64(self.buckets)).astype(np.int32)
        order = np.argsort(bucket, kind="stable")
        i, bucket = i[order], bucket[order]
        cuts = np.append(np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])), len(i)).tolist()
        low, high = np.searchsorted(rare_at, start[i]), np.searchsorted(rare_at, start[i] + size[i])
        strings = []
        for a, z in zip(cuts, cuts[1:]):
            r = i[a:z]
            rare = b" ".join([self.rare[k] for k in ragged(low[a:z], high[a:z] - low[a:z]).tolist()])
            some = codes[ragged(start[r], size[r])]
            data = b"".join([doc[r].astype("<i8").tobytes(), digest[r].astype("<u4").tobytes(),
                             place[r].astype("<i4").tobytes(), size[r].astype("u1").tobytes(), some.tobytes(), rare])
            strings.append(struct.pack(HEAD, len(data), len(r), len(some)) + pa.compress(data, "zstd", asbytes=True))
        bucket = bucket[cuts[:-1]]
        for at in range(0, len(strings), 256):
            yield _rows(bucket[at:at + 256], strings[at:at + 256])
        self.clear()


class Names(dict):
    """Numbers, from CODES on, of the words without codes."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = CODES + len(self)
        return value


class Block:
    """Packed strings of a bucket, unpacked into one array of words."""

    def __init__(self, strings: list[bytes]):
        parts, rare = [], []
        for s in strings:
            size, n, words = struct.unpack_from(HEAD, s)
            data = pa.decompress(s[struct.calcsize(HEAD):], size, "zstd", asbytes=True)
            at, part = 0, []
            for kind, count in (("<i8", n), ("<u4", n), ("<i4", n), ("u1", n), ("<u2", words)):
                part.append(np.frombuffer(data, kind, count, at))
                at += part[-1].nbytes
            parts.append(part)
            if at < len(data):
                rare.append(data[at:])
        self.doc, self.digest, self.place, size, codes = (np.concatenate(c) for c in zip(*parts))
        self.ids = codes.astype(np.int64)
        names = Names()
        at = np.flatnonzero(self.ids == CODES)
        if len(at):                                              # in order of strings and of places within
            self.ids[at] = np.fromiter(map(names.__getitem__, b" ".join(rare).split(b" ")), np.int64, len(at))
        self.names = list(names)
        windows = size.astype(np.int64) - WINDOW + 1
        first = np.cumsum(size.astype(np.int64)) - size
        self.row = np.repeat(np.arange(len(windows)), windows)
        self.start = ragged(first, windows)                      # of each window, among the words
        self.window = ragged(np.zeros(len(windows), np.int64), windows)

    def smaller(self) -> np.ndarray:
        """Mask of the windows that also start in a smaller document of the bucket."""
        n = max(0, len(self.ids) - WINDOW + 1)
        mixed, ids = np.zeros(n, np.uint64), self.ids.astype(np.uint64)
        for j, m in enumerate(odd_multipliers(WINDOW, 31)):
            mixed += ids[j:j + n] * m
        mixed = splitmix(mixed)[self.start]
        order = np.argsort(mixed, kind="stable")
        equal = mixed[order[1:]] == mixed[order[:-1]]
        here, before = self.start[order[1:][equal]], self.start[order[:-1][equal]]
        if any((self.ids[here + j] != self.ids[before + j]).any() for j in range(WINDOW)):
            order = np.lexsort([self.ids[self.start + j] for j in range(WINDOW)])     # different windows, one hash
            here, before = self.start[order[1:]], self.start[order[:-1]]
            equal = np.logical_and.reduce([self.ids[here + j] == self.ids[before + j] for j in range(WINDOW)])
        out = np.zeros(len(order), bool)
        if len(order):
            runs = np.append(0, np.flatnonzero(~equal) + 1)
            doc = self.doc[self.row][order]
            least = np.minimum.reduceat(doc, runs)
            out[order] = doc > np.repeat(least, np.diff(np.append(runs, len(order))))
        return out

    def ranges(self, removed: np.ndarray) -> tuple[np.ndarray, ...]:
        """(document, text hash, first word, end) of the stretches of removed windows."""
        at = np.flatnonzero(removed)
        row, w = self.row[at], self.window[at]
        new = np.append(True, (row[1:] != row[:-1]) | (w[1:] != w[:-1] + 1)) if len(at) else np.zeros(0, bool)
        last = np.append(np.flatnonzero(new)[1:], len(at)) - 1 if len(at) else np.zeros(0, np.int64)
        r = row[new]
        return self.doc[r], self.digest[r], self.place[r] + w[new], self.place[r] + w[last] + WINDOW

    def word(self, i: int) -> bytes:
        """Bytes that stand for a word wherever it occurs."""
        return struct.pack("<H", i) if i < CODES else b"\xff\xff" + self.names[i - CODES] + b" "


def _found(doc, digest, first, end, window=None) -> pa.RecordBatch:
    window = [None] * len(doc) if window is None else window
    return pa.RecordBatch.from_arrays(
        [pa.array(doc, pa.int64()), pa.array(digest, pa.int64()), pa.array(first, pa.int32()), pa.array(end, pa.int32()),
         pa.array(window, pa.binary())], names=["doc", "digest", "first", "end", "window"])


def _buckets(batches):
    """Removed ranges, from rows sorted by bucket; a bucket that is too large gives its windows one by one."""
    bucket, held, size, large = None, [], 0, False

    def work():
        if held:
            block = Block(held)
            yield _found(*block.ranges(block.smaller()))

    def windows(strings):
        block = Block(strings)
        ids = block.ids.tolist()
        for at in range(0, len(block.row), 16_384):
            r, w = block.row[at:at + 16_384], block.window[at:at + 16_384]
            text = [b"".join([block.word(i) for i in ids[s:s + WINDOW]]) for s in block.start[at:at + 16_384].tolist()]
            first = block.place[r] + w
            yield _found(block.doc[r], block.digest[r], first, first + WINDOW, text)

    for b in slices(batches, 256):
        own, strings = b.column(0).to_pylist(), b.column(1)
        decided = b.filter(strings.is_null())
        if decided.num_rows:
            yield _found(*(np.asarray(decided.column(k)) for k in range(2, 6)))
        for key, data in zip(own, strings.to_pylist()):
            if data is None:
                continue
            if key != bucket:
                yield from work()
                bucket, held, size, large = key, [], 0, False
            if large:
                yield from windows([data])
                continue
            held.append(data)
            size += struct.unpack_from(HEAD, data)[1]
            if size > LARGE:
                for some in held:
                    yield from windows([some])
                held, large = [], True
    yield from work()


def removed_ranges(docs: DataFrame) -> DataFrame:
    """(doc, digest, first, end): ranges of removed words."""
    coded, heavy, n_windows = _frequencies(docs)
    shared = PerWorker(docs.sparkSession, Cutter, coded, heavy, max(1, -(-n_windows // PER_BUCKET)))

    def cut(batches):
        held = shared.get()
        held.clear()
        for b in slices(batches):
            rows = zip(*(b.column(k).to_pylist() for k in range(3)))
            texts = [(doc, digest, split(text)) for doc, digest, text in rows if doc is not None]
            held.add([t for t in texts if len(t[2]) >= WINDOW])
            if held.n_strings > HELD:
                yield from held.flush()
        yield from held.flush()

    strings = map_arrow(docs.select("doc_id", "digest", "text"), cut, ROWS_SCHEMA)
    found = map_arrow(strings.repartition("bucket").sortWithinPartitions("bucket"), _buckets,
                      "doc bigint, digest bigint, first int, end int, window binary")
    found = materialize(found, "removed")
    large = found.filter("window is not null")
    least = large.groupBy("window").agg(F.min("doc").alias("least"))
    late = large.join(least, "window").filter("doc > least")
    names = ["doc", "digest", "first", "end"]
    return found.filter("window is null").select(*names).unionByName(late.select(*names))


def _kept(batches):
    for b in slices(batches):
        n, gone, kept = [], [], []
        for text, first, end in zip(*(b.column(k).to_pylist() for k in (1, 2, 3))):
            words = split(text)
            keep = np.ones(len(words), bool)
            for a, z in zip(first or [], end or []):
                keep[a:z] = False
            n.append(len(words))
            gone.append(len(words) - int(keep.sum()))
            kept.append(b" ".join(compress(words, keep.tolist()) if gone[-1] else words))
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(gone, pa.int64()),
                                          pa.array(kept, pa.binary()).cast(pa.string())],
                                         names=["doc_id", "n_words", "n_removed", "kept"])


def remove_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_removed, kept): every row's text without repeated windows, words joined by one space."""
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .withColumn("digest", F.xxhash64("text").bitwiseAND(F.lit(0xFFFFFFFF)))
    ranges = removed_ranges(docs).groupBy("doc", "digest").agg(F.collect_set(F.struct("first", "end")).alias("r"))
    joined = docs.join(ranges.withColumnRenamed("doc", "doc_id"), ["doc_id", "digest"], "left")
    return map_arrow(joined.select("doc_id", "text", "r.first", "r.end"), _kept,
                     "doc_id bigint, n_words bigint, n_removed bigint, kept string")


def digests(docs: DataFrame) -> DataFrame:
    """op11: (doc_id, n_words, n_removed, kept_sha256)."""
    return remove_repeats(docs).select("doc_id", "n_words", "n_removed",
                                       F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


ORACLE_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
words AS (SELECT rid, doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM docs),
windows AS (
  SELECT rid, doc_id, i, word, count(*) OVER next AS n, string_agg(word, ' ') OVER next AS win
  FROM words WINDOW next AS (PARTITION BY rid ORDER BY i ROWS BETWEEN CURRENT ROW AND 12 FOLLOWING)),
least AS (SELECT win, min(doc_id) AS least FROM windows WHERE n = 13 GROUP BY win),
marked AS (
  SELECT w.rid, w.i, w.word, coalesce(w.n = 13 AND l.least < w.doc_id, false) AS late
  FROM windows w LEFT JOIN least l ON w.n = 13 AND l.win = w.win),
covered AS (
  SELECT rid, i, word,
         max(late::INT) OVER (PARTITION BY rid ORDER BY i ROWS BETWEEN 12 PRECEDING AND CURRENT ROW) = 1 AS gone
  FROM marked),
texts AS (
  SELECT rid, count(*) FILTER (WHERE gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (WHERE NOT gone) AS kept
  FROM covered GROUP BY rid)
SELECT d.doc_id, len(d.words)::BIGINT AS n_words, coalesce(t.n_removed, 0)::BIGINT AS n_removed,
       sha256(coalesce(t.kept, '')) AS kept_sha256
FROM docs d LEFT JOIN texts t USING (rid)
"""
