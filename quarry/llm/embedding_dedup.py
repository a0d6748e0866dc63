"""Near-duplicate vectors by sorted projection passes.

Equal vectors of a label are one class. A pass gives each class a hash of 63
random hyperplanes' signs and sorts the classes of a label by it, first bit
first, so that similar vectors, which agree in most bits, often stand near
each other. Neighbours in a window are compared in slices of a matrix product.
Each pass has hyperplanes of its own, and the pairs it finds are united with
those of the other passes to components.

* The number of passes follows the data. Two vectors at the threshold agree
  in a bit with probability ``1 - acos(THRESHOLD) / pi``, and meet in a pass
  when they agree in as many bits as it takes to narrow the label down to a
  window. How many that is, is measured on a bounded sample of the largest
  label for each pass's hash; there are as many passes as make a pair be missed
  by all of them with probability ``MISS``.
* A pass sends each class once, as 4-byte floats, so windows use a threshold
  lowered by their rounding. The classes of a component found so are then
  compared in full, in double precision, in pairs of bounded blocks: this
  verifies the pairs and counts the links of vectors that no window held
  together.

No pair is ever a row: a task returns for each class with links one member of
its component. Work and shuffle are linear in rows and passes, and passes grow
with a small power of the label, besides the square of the classes in one
found component.

Defined results: vectors that are null, empty, all zero or hold null or
non-finite components, and rows without a label, link with nothing; vectors of
different length never link; repeated rows link to each other; rows of one id
are counted one by one; other columns are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import map_arrow
from quarry.llm.graph import components
from quarry.session import materialize, ship_package

THRESHOLD = 0.93
MISS = 1e-3               # a pair at the threshold is missed by all passes with this probability, about
WINDOW = 1024             # classes in a block; a class meets its own block and both neighbours
BITS = 63                 # hyperplanes of a pass
SAMPLE = 16_384           # classes of the largest label that the number of passes is measured on, about
LEAST_CHANCE = 0.01       # of meeting in a pass: bounds the passes where almost all vectors point one way
ROUNDING = 1e-5           # of a cosine in 4-byte floats
PART_BLOCKS = 16          # blocks in a task's part of a sorted pass, about
COMPONENT_BLOCK = 8192    # classes of a component in one block
BLOCK = 1024              # classes of a block compared with another block at a time


def unit_rows(vectors: pa.ChunkedArray) -> np.ndarray:
    """Unit vectors of rows of one length."""
    x = np.asarray(vectors.combine_chunks().flatten(), np.float64).reshape(len(vectors), -1)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest member of each node's component under the links a-b."""
    parent = np.arange(n)
    while True:
        low = np.minimum(parent[a], parent[b])
        new = parent.copy()
        np.minimum.at(new, parent[a], low)
        np.minimum.at(new, parent[b], low)
        new = new[new]
        if (new == parent).all():
            return parent
        parent = new


def linked(x: np.ndarray, left: np.ndarray, right: np.ndarray, copies: np.ndarray,
           threshold: float = THRESHOLD) -> tuple[np.ndarray, np.ndarray]:
    """Rows linked to each member, and the first member of its component, over the pairs of ``left`` and ``right``.

    Equal sides are one block, of which each pair counts once.
    """
    n, root = np.zeros(len(x), np.int64), np.arange(len(x))
    same = left is right
    for at in range(0, len(left), BLOCK):
        rows, cols = left[at:at + BLOCK], right[at:] if same else right
        near = x[rows] @ x[cols].T >= threshold
        if same:
            near &= rows[:, None] < cols[None, :]
        i, j = np.flatnonzero(near.any(axis=1)), np.flatnonzero(near.any(axis=0))
        if not len(i):
            continue
        rows, cols, near = rows[i], cols[j], near[np.ix_(i, j)]
        n[rows] += near @ copies[cols]
        n[cols] += copies[rows] @ near
        while len(rows):                     # each row with links out of its component joins one of them
            near &= root[rows][:, None] != root[cols][None, :]
            out = near.any(axis=1)
            rows, near = rows[out], near[out]
            root = _roots(len(x), np.concatenate([np.arange(len(x)), rows]),
                          np.concatenate([root, cols[near.argmax(axis=1)]] if len(rows) else [root]))
    return n, root


def _classes(vectors: DataFrame) -> DataFrame:
    """(c, label, embedding, copies, id): distinct usable vectors of each label."""
    e = F.col("embedding").cast("array<double>")
    finite = F.forall(e, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    usable = vectors.filter(F.col("label").isNotNull() & F.col("embedding").isNotNull()) \
        .withColumn("embedding", e).filter(finite & F.exists("embedding", lambda v: v != 0.0))
    # a vector's sum of squares may leave the range of doubles: bring the largest component to 1
    top = F.array_max(F.transform("embedding", F.abs))
    usable = usable.withColumn("embedding", F.transform("embedding", lambda v: v / top))
    return usable.groupBy("label", "embedding").agg(F.count("*").alias("copies"), F.min("vec_id").alias("id")) \
        .withColumn("c", F.monotonically_increasing_id())


# ------------------------------------------------------------------ passes


def hashes(x: np.ndarray, pass_: int) -> np.ndarray:
    """Signs of the pass's random projections as one integer, the first projection in the highest bit."""
    planes = np.random.default_rng([pass_, x.shape[1], 17]).normal(size=(x.shape[1], BITS)).astype(x.dtype)
    return (x @ planes > 0) @ (1 << np.arange(BITS - 1, -1, -1, dtype=np.int64))


def meeting_chance(x: np.ndarray, size: int, pass_: int) -> np.ndarray:
    """Chance that a pair at the threshold meets in the window, for each vector of a sample of a label of ``size``."""
    agree = 1 - math.acos(THRESHOLD) / math.pi
    h = np.sort(hashes(x, pass_))
    share = WINDOW / size * len(h)                          # sample rows in a window
    width = max(1, min(len(h), round(share)))
    first = np.maximum(0, np.minimum(np.arange(len(h)) - width // 2, len(h) - width))
    differ = h[first] ^ h[first + width - 1]                # bits that are equal all over the window are not needed
    same = np.array([BITS - int(d).bit_length() for d in differ])
    return agree ** np.minimum(BITS, same + max(0.0, math.log2(width / share)))


def passes_for(sample: np.ndarray, size: int) -> int:
    """Passes that leave a pair at the threshold unmet with probability ``MISS``, about."""
    if size <= WINDOW:
        return 1
    chance = np.mean([meeting_chance(sample, size, p) for p in range(8)], axis=0)
    low = max(LEAST_CHANCE, float(np.quantile(chance, 0.05)) * (1 - 0.5 / PART_BLOCKS))
    return max(1, math.ceil(math.log(MISS) / math.log1p(-min(low, 0.99))))


def _passes(classes: DataFrame) -> int:
    """The number of passes, measured in one task on a bounded sample of the largest label."""
    top = classes.groupBy("label", F.size("embedding").alias("dims")).count().orderBy(F.desc("count"), "label").first()
    if top is None:
        return 0
    size = top["count"]
    own = classes.filter(F.col("label").eqNullSafe(F.lit(top["label"])) & (F.size("embedding") == top["dims"]))
    if size > SAMPLE:
        own = own.filter(F.pmod(F.xxhash64("c"), F.lit(1 << 30)) < int((1 << 30) * SAMPLE / size))

    def run(table: pa.Table) -> pa.Table:
        return pa.table({"passes": pa.array([passes_for(unit_rows(table["embedding"]), size)], pa.int64())})

    ship_package()
    found = own.withColumn("part", F.lit(0)).groupBy("part").applyInArrow(run, "passes bigint").first()
    return found.passes if found else 1


def _hashed(classes: DataFrame, passes: int) -> DataFrame:
    """(pass, label, dims, h, c, v): each class once for each pass, its unit vector as 4-byte floats."""
    kind = classes.schema["label"].dataType.simpleString()

    def run(batches):
        for b in batches:
            dims = np.asarray(b.column(2))
            for d in np.unique(dims):
                part = b.filter(pa.array(dims == d))
                x = unit_rows(pa.chunked_array([part.column(3)])).astype(np.float32)
                v = pa.array([r.tobytes() for r in x], pa.binary())
                for p in range(passes):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(x), p, np.int32)), part.column(1), part.column(2), pa.array(hashes(x, p)),
                         part.column(0), v], names=["pass", "label", "dims", "h", "c", "v"])

    rows = classes.select("c", "label", F.size("embedding").alias("dims"), "embedding")
    return map_arrow(rows, run, f"pass int, label {kind}, dims int, h bigint, c bigint, v binary")


def _windows(batches):
    """Candidate links (u, v) of rows that come in the order of a pass, label and hash: u's component in its window."""
    segment, pending, waiting, before = None, [], 0, None

    def compare(c, x, before):
        if before is not None:
            c, x = np.concatenate([before[0], c]), np.concatenate([before[1], x])
        own = np.arange(len(before[0]) if before is not None else 0, len(c))
        one = np.ones(len(c), np.int64)
        for left, right in [(own, own)] + ([(np.arange(own[0]), own)] if before is not None else []):
            n, root = linked(x, left, right, one, THRESHOLD - ROUNDING)
            some = np.flatnonzero((n > 0) & (root != np.arange(len(c))))
            if len(some):
                yield pa.RecordBatch.from_arrays([pa.array(c[some]), pa.array(c[root[some]])], names=["u", "v"])

    def blocks(final):
        nonlocal pending, waiting, before
        if not waiting or (waiting < WINDOW and not final):
            return
        c, x = (np.concatenate(part) for part in zip(*pending))
        at = 0
        while len(c) - at >= WINDOW or (final and at < len(c)):
            own = c[at:at + WINDOW], x[at:at + WINDOW]
            yield from compare(*own, before)
            before, at = own, at + WINDOW
        pending, waiting = ([(c[at:], x[at:])], len(c) - at) if at < len(c) else ([], 0)

    for b in batches:
        if not b.num_rows:
            continue
        keys = list(zip(*(b.column(k).to_pylist() for k in range(3))))
        cuts = [0, *(i for i in range(1, len(keys)) if keys[i] != keys[i - 1]), len(keys)]
        for start, end in zip(cuts, cuts[1:]):
            if keys[start] != segment:
                yield from blocks(True)
                segment, before = keys[start], None
            part = b.slice(start, end - start)
            x = np.frombuffer(b"".join(part.column(5).to_pylist()), np.float32).reshape(part.num_rows, -1)
            pending.append((np.asarray(part.column(4)), x))
            waiting += part.num_rows
            yield from blocks(False)
    yield from blocks(True)


def _candidates(classes: DataFrame) -> DataFrame:
    """(u, v): links that the windows of all passes find, as stars of their components."""
    passes = _passes(classes)
    if not passes:
        return classes.select(F.col("c").alias("u"), F.col("c").alias("v"))
    n = classes.count()
    parts = max(1, math.ceil(n * passes / (PART_BLOCKS * WINDOW)))
    order = ["pass", "label", "dims", "h", "c"]
    dealt = _hashed(classes, passes).repartitionByRange(parts, *order).sortWithinPartitions(*order)
    return map_arrow(dealt, _windows, "u bigint, v bigint").distinct()


# ------------------------------------------------------------------ components


def _compare(members: DataFrame) -> DataFrame:
    """(u, v, n): for each pair of blocks of a ``root``, its classes u with links, their first class v and rows n
    linked to u."""
    members = members.select("root", "c", "copies", "embedding")
    size = members.groupBy("root").agg(F.count("*").alias("size"))
    members = members.join(size, "root") \
        .withColumn("blocks", F.ceil(F.col("size") / COMPONENT_BLOCK).cast("int")) \
        .withColumn("own", F.pmod(F.xxhash64("c"), F.col("blocks")).cast("int"))
    # every pair of blocks meets in one group, a block with itself too
    dealt = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))) \
        .select("root", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "c",
                "copies", "embedding")

    def run(table: pa.Table) -> pa.Table:
        own, c, copies = (np.asarray(table[k]) for k in ("own", "c", "copies"))
        first, second = table["i"][0].as_py(), table["j"][0].as_py()
        left = np.flatnonzero(own == first)
        n, root = linked(unit_rows(table["embedding"]), left, left if first == second else np.flatnonzero(own == second),
                         copies)
        some = np.flatnonzero(n)
        return pa.table({"u": c[some], "v": c[root[some]], "n": n[some]})

    ship_package()
    return dealt.groupBy("root", "i", "j").applyInArrow(run, "u bigint, v bigint, n bigint")


def near_duplicates(vectors: DataFrame) -> DataFrame:
    """op3: (vec_id, n_links, component_id, kept) of every row of (vec_id, embedding, label)."""
    vectors = vectors.select("vec_id", "embedding", "label")
    classes = materialize(_classes(vectors), "classes")
    found = materialize(components(_candidates(classes)).withColumnRenamed("node", "c"), "found")
    links = materialize(_compare(classes.join(found, "c")), "links")
    n = links.groupBy(F.col("u").alias("c")).agg(F.sum("n").alias("n"))
    roots = materialize(components(links.select("u", "v")).withColumnRenamed("node", "c"), "roots")
    least = roots.join(classes.select("c", "id"), "c").groupBy("root").agg(F.min("id").alias("component"))
    result = classes.join(n, "c", "left").join(roots, "c", "left").join(least, "root", "left") \
        .select("label", "embedding", "copies", F.coalesce("component", "id").alias("component"),
                F.coalesce("n", F.lit(0)).alias("n"))
    top = F.array_max(F.transform(F.col("embedding").cast("array<double>"), F.abs))
    scaled = vectors.withColumn("embedding", F.transform(F.col("embedding").cast("array<double>"),
                                                         lambda v: F.try_divide(v, top)))
    out = scaled.join(result, ["label", "embedding"], "left")
    component = F.coalesce("component", "vec_id")
    return out.select("vec_id", (F.coalesce("n", F.lit(0)) + F.coalesce("copies", F.lit(1)) - 1).alias("n_links"),
                      component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))
