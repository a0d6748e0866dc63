"""Near-duplicate documents by SetSketch registers over 5-word shingles.

1. Every document becomes its shingle set's size, fingerprint and SetSketch:
   register i is floor(1 - log_b(h_i)), cut to 0 .. q+1, of the smallest of the
   set's exponential hashes h_i. Registers merge by maximum (``merge``).
2. Documents with one fingerprint have one set, so each distinct set goes on
   once as a vertex; copies share its fate however many they are.
3. Band keys of ``ROWS`` registers form buckets. A pair with similarity 0.85
   meets in none of the 24 bands with probability (1 - 0.85 ** 6) ** 24,
   about 1e-5.
4. Each bucket's members are first compared with its smallest one. Links make
   components; a bucket that lies in one component needs no more.
5. The other buckets are compared in full, in pairs of bounded blocks: all
   estimates of a block pair are made in numpy, and pairs not connected yet
   are verified best first. Only links that connect leave the task, never
   pairs, so no link between members of a bucket is lost.
6. A pair is estimated from both sketches jointly: with known set sizes,
   maximum likelihood over the counts of larger, smaller and equal registers.
   Pairs ``SIGMAS`` standard deviations below the threshold go; the others are
   verified on full shingle sets.

Defined results: null, empty and blank texts have an empty set and link with
nothing; texts below five words are one shingle; repeated rows link to each
other; rows with one id and different texts are different documents; a null id
is never a component's smallest; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import PerWorker, map_arrow, odd_multipliers, slices, splitmix
from quarry.llm.graph import components
from quarry.llm.shingles import WordHashes, shingle_set
from quarry.session import materialize, ship_package

BANDS, ROWS = 24, 6
REGISTERS = BANDS * ROWS
BASE, RATE, LIMIT = 1.001, 20.0, 65534      # b, a and q of the sketch
SIGMAS = 4.0                                # distance below the threshold at which an estimate rejects a pair
BLOCK, BLOCK_SHINGLES = 1024, 4_000_000     # members of a bucket, and their shingles, in one block


def sketch_sets(sets: list[np.ndarray]) -> np.ndarray:
    """Registers (sets x REGISTERS, uint16) of non-empty sets of mixed 64-bit hashes."""
    values = np.concatenate(sets)
    starts = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]]).astype(np.intp)
    low = np.empty((REGISTERS, len(sets)), np.uint64)
    for i, m in enumerate(odd_multipliers(REGISTERS, 23)):
        low[i] = np.minimum.reduceat(values * m, starts)
    h = -np.log1p(-(low.T.astype(np.float64) + 0.5) / 2.0 ** 64) / RATE
    h = np.maximum(h, 1e-300)
    return np.clip(np.floor(1 - np.log(h) / np.log(BASE)), 0, LIMIT + 1).astype("<u2")


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sketch of the union of two sets."""
    return np.maximum(a, b)


def estimate(larger: np.ndarray, smaller: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Maximum-likelihood similarity from the numbers of registers of a that are larger and smaller than b's."""
    n_a, n_b = n_a[:, None].astype(float), n_b[:, None].astype(float)
    u, v = n_a / (n_a + n_b), n_b / (n_a + n_b)
    most = np.minimum(n_a, n_b) / np.maximum(n_a, n_b)
    j = most * np.linspace(0.0, 1.0, 201)[None, :]

    def p(x):
        return -np.log1p(-x * (BASE - 1) / BASE) / np.log(BASE)

    up, down = np.maximum(p(u - v * j), 1e-12), np.maximum(p(v - u * j), 1e-12)
    same = np.maximum(1 - up - down, 1e-12)
    larger, smaller = larger[:, None], smaller[:, None]
    score = larger * np.log(up) + smaller * np.log(down) + (REGISTERS - larger - smaller) * np.log(same)
    return j[np.arange(len(j)), score.argmax(axis=1)]


def cutoff(percent: int) -> float:
    """Estimate below which a pair is ruled out."""
    return percent / 100 - SIGMAS * (percent / 100 * (1 - percent / 100) / REGISTERS) ** 0.5


def _sketches(docs: DataFrame) -> DataFrame:
    """(id, n, print, sketch): size, 128-bit fingerprint and registers of every document's set."""
    shared = PerWorker(docs.sparkSession, WordHashes)

    def run(batches):
        import xxhash

        hashes = shared.get()
        for b in slices(batches):
            sets = [shingle_set(hashes.of(t)) for t in b.column(1).to_pylist()]
            full = [s for s in sets if len(s)]
            rows = iter(sketch_sets(full)) if full else iter(())
            yield pa.RecordBatch.from_arrays([
                b.column(0), pa.array([len(s) for s in sets], pa.int64()),
                pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                pa.array([next(rows).tobytes() if len(s) else None for s in sets], pa.binary()),
            ], names=["id", "n", "print", "sketch"])

    kind = docs.schema["id"].dataType.simpleString()
    return map_arrow(docs.select("id", F.col("text").cast("string")), run,
                     f"id {kind}, n bigint, print binary, sketch binary")


def _registers(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u2").reshape(len(column), REGISTERS)


def _buckets(vertices: DataFrame) -> DataFrame:
    """(key, v): one row per vertex and band."""
    def run(batches):
        for b in slices(batches, 4096):
            bands = _registers(b.column(1)).reshape(b.num_rows, BANDS, ROWS).astype(np.uint64)
            key = (bands * odd_multipliers(ROWS, 31)).sum(axis=2) + odd_multipliers(BANDS, 37)
            yield pa.RecordBatch.from_arrays([
                pa.array(splitmix(key).ravel().view(np.int64)),
                pa.array(np.repeat(np.asarray(b.column(0)), BANDS))], names=["key", "v"])

    return map_arrow(vertices.select("v", "sketch"), run, "key bigint, v bigint")


def _likely(pairs: DataFrame, vertices: DataFrame, percent: int) -> DataFrame:
    """Pairs that the sketches do not rule out."""
    least = cutoff(percent)

    def run(batches):
        for b in slices(batches, 2048):
            x, y = _registers(b.column(2)), _registers(b.column(3))
            j = estimate((x > y).sum(axis=1), (x < y).sum(axis=1), np.asarray(b.column(4)), np.asarray(b.column(5)))
            yield b.select([0, 1]).filter(pa.array(j >= least))

    side = lambda c: vertices.select(F.col("v").alias(c), F.col("n").alias(f"n_{c}"), F.col("sketch").alias(f"s_{c}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b") \
        .filter(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))
    return map_arrow(both.select("a", "b", "s_a", "s_b", "n_a", "n_b"), run, "a bigint, b bigint")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs whose full sets reach the threshold."""
    def run(batches):
        for b in slices(batches, 256):
            keep = []
            for x, y in zip(b.column(2).to_pylist(), b.column(3).to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * common >= percent * (len(x) + len(y) - common))
            yield b.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    side = lambda c: sets.select(F.col("v").alias(c), F.col("set").alias(f"set_{c}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    return map_arrow(both.select("a", "b", "set_a", "set_b"), run, "a bigint, b bigint")


def _full_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(v, set) of the vertices ``wanted(v, id, print)``, from the text of one document each."""
    shared = PerWorker(docs.sparkSession, WordHashes)

    def run(batches):
        import xxhash

        hashes = shared.get()
        for b in slices(batches):
            sets = [shingle_set(hashes.of(t)).tobytes() for t in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([xxhash.xxh3_128_digest(s) for s in sets], pa.binary()),
                                              pa.array(sets, pa.binary())], names=["print", "set"])

    ids = wanted.select("id").distinct()
    texts = docs.join(ids, docs["id"].eqNullSafe(ids["id"]), "left_semi").select(F.col("text").cast("string"))
    return map_arrow(texts, run, "print binary, set binary").join(wanted.select("v", "print"), "print") \
        .dropDuplicates(["v"]).select("v", "set")


def _roots(members: DataFrame, links: DataFrame) -> DataFrame:
    """``members(key, v, ...)`` with the smallest vertex that links reach from v."""
    roots = components(links).withColumnRenamed("node", "v")
    return members.join(roots, "v", "left").withColumn("root", F.coalesce("root", "v"))


def _undecided(members: DataFrame, links: DataFrame) -> DataFrame:
    """(key, v, root) of buckets that links leave in several components."""
    rooted = materialize(_roots(members, links), "rooted")
    keys = rooted.groupBy("key").agg(F.min("root").alias("x"), F.max("root").alias("y")).filter("x != y").select("key")
    return materialize(rooted.join(keys, "key"), "undecided")


def _decide(members: DataFrame, vertices: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b): links that connect, in every bucket of ``members(key, v, root)``, what any of its pairs links.

    A bucket is cut into blocks, and each pair of blocks is one task's work:
    estimates of all pairs in numpy, then, best first, full sets of pairs that
    are not connected yet. Only connecting links leave the task.
    """
    floor = cutoff(percent)

    def run(table: pa.Table) -> pa.Table:
        v = np.asarray(table["v"])
        v, first = np.unique(v, return_index=True)
        table = table.take(pa.array(first))
        own, n = np.asarray(table["own"]), np.asarray(table["n"])
        mine = np.asarray(table["i"])[0]
        within = mine == np.asarray(table["j"])[0]
        registers = np.frombuffer(b"".join(table["sketch"].to_pylist()), "<u2").reshape(len(v), REGISTERS)
        full = [np.frombuffer(x, np.uint64) for x in table["set"].to_pylist()]
        roots = np.asarray(table["root"])
        parent = {int(r): int(r) for r in roots}

        def find(x: int) -> int:
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        found = [(np.zeros(0), np.zeros(0, np.int32), np.zeros(0, np.int32))]
        for x in range(len(v)):
            if not within and own[x] != mine:
                continue
            other = np.arange(x + 1, len(v)) if within else np.flatnonzero(own != mine)
            other = other[(roots[other] != roots[x])
                          & (100 * np.minimum(n[other], n[x]) >= percent * np.maximum(n[other], n[x]))]
            same = (registers[other] == registers[x]).mean(axis=1)
            other = other[same >= floor - 0.05]
            if len(other):
                up = (registers[x] > registers[other]).sum(axis=1)
                down = (registers[x] < registers[other]).sum(axis=1)
                j = estimate(up, down, np.full(len(other), n[x]), n[other])
                other, j = other[j >= floor], j[j >= floor]
                found.append((j, np.full(len(other), x, np.int32), other.astype(np.int32)))
        score, left, right = (np.concatenate(c) for c in zip(*found))
        links = []
        for k in np.argsort(-score, kind="stable"):
            x, y = int(left[k]), int(right[k])
            r, q = find(int(roots[x])), find(int(roots[y]))
            if r != q:
                common = len(np.intersect1d(full[x], full[y], assume_unique=True))
                if 100 * common >= percent * (len(full[x]) + len(full[y]) - common):
                    parent[max(r, q)] = min(r, q)
                    links.append((v[x], v[y]))
        return pa.table({"a": pa.array([a for a, _ in links], pa.int64()), "b": pa.array([b for _, b in links], pa.int64())})

    data = vertices.select("v", "n", "sketch").join(sets, "v")
    size = members.join(vertices.select("v", "n"), "v").groupBy("key").agg(F.count("*").alias("c"), F.sum("n").alias("s")) \
        .select("key", F.ceil(F.greatest(F.col("c") / BLOCK, F.col("s") / BLOCK_SHINGLES)).cast("int").alias("blocks"))
    cut = members.join(size, "key").withColumn("own", F.pmod(F.xxhash64("v"), F.col("blocks")).cast("int")) \
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    work = cut.select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "v", "root") \
        .join(data, "v")
    ship_package()
    return work.groupBy("key", "i", "j").applyInArrow(run, "a bigint, b bigint")


def _links(docs: DataFrame, vertices: DataFrame, percent: int) -> DataFrame | None:
    """(u, v) links that connect what the buckets' pairs connect; None if no bucket has two members."""
    buckets = _buckets(vertices)
    shared_keys = buckets.groupBy("key").agg(
        F.count("*").alias("c"), F.min("v").alias("p"), F.max("v").alias("q"),
        F.sum(F.xxhash64("v").cast("decimal(20,0)")).alias("h")).filter("c > 1") \
        .groupBy("c", "p", "q", "h").agg(F.min("key").alias("key")).select("key", "p")   # equal buckets once
    members = materialize(buckets.join(shared_keys, "key"), "buckets")
    if members.isEmpty():
        return None
    wanted = members.select("v").distinct().join(vertices.select("v", "id", "print"), "v")
    sets = materialize(_full_sets(docs, wanted), "sets")
    pairs = members.filter("v != p").select(F.col("p").alias("a"), F.col("v").alias("b")).distinct()
    star = materialize(_verified(_likely(pairs, vertices, percent), sets, percent), "links")
    rename = lambda links: links.select(F.col("a").alias("u"), F.col("b").alias("v"))
    open_members = _undecided(members.select("key", "v"), rename(star))
    if open_members.isEmpty():
        return rename(star)
    return rename(star.unionByName(materialize(_decide(open_members, vertices, sets, percent), "links")))


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 85) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept): near-duplicate groups under similarity >= percent / 100."""
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    sketches = materialize(_sketches(docs), "sketches")
    vertices = materialize(
        sketches.filter("n > 0").groupBy("print").agg(F.min("id").alias("id"), F.first("n").alias("n"),
                                                      F.first("sketch").alias("sketch"))
        .withColumn("v", F.monotonically_increasing_id()), "vertices")
    classes = vertices.select("v", "print", "id")
    links = _links(docs, vertices, percent)
    if links is not None:
        roots = components(links).withColumnRenamed("node", "v")
        named = classes.join(roots, "v", "left").withColumn("root", F.coalesce("root", "v"))
        least = named.groupBy("root").agg(F.min("id").alias("component"))
        classes = named.join(least, "root").select("print", "component")
    else:
        classes = classes.select("print", F.col("id").alias("component"))
    out = sketches.select("id", "n", "print").join(classes, "print", "left") \
        .withColumn("component", F.coalesce("component", "id"))
    return out.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"),
                      F.col("component").alias("component_id"),
                      F.col("id").eqNullSafe(F.col("component")).alias("kept"))


def keep_one(docs: DataFrame, percent: int = 85) -> DataFrame:
    """One document of each group, with all columns of ``docs``.

    A row is known by its id and text: rows of one id with different texts are documents of their own, and rows
    equal in both are one document, whatever their other columns hold. Of a group the smallest id stays, a null id
    first, and of one id's texts the one of the smallest hash.
    """
    digest = F.xxhash64(F.col("text").cast("string"), F.lit(5))
    keyed = docs.select(F.struct(F.col("doc_id").alias("id"), digest.alias("digest")).alias("doc_id"), "text")
    grouped = groups(keyed, percent=percent).filter("kept").select("doc_id")
    kept = materialize(grouped.groupBy("doc_id").agg(F.count("*").alias("c")), "kept")
    mine = F.struct(docs["doc_id"].alias("id"), F.xxhash64(docs["text"].cast("string"), F.lit(5)).alias("digest"))
    out = docs.join(kept.select(F.col("doc_id").alias("kept_id")), mine.eqNullSafe(F.col("kept_id")), "left_semi")
    if not kept.filter("c > 1").isEmpty():
        out = out.dropDuplicates(["doc_id", "text"])
    return out
