"""Toxicity by a subsequence string kernel, a support vector machine and Nystroem landmarks.

Units are the lower-cased words of a text, and runs of single characters
("i d i o t") read as one word. The kernel of two units sums, over all
character triples, the products of their gap-weighted occurrences: a triple
spread over s characters weighs GAP ** (s - 3), up to MAX_SPAN characters. An
inserted or missing character so changes a unit's features a little only.

Training uses a bounded sample of labelled documents, sentence by sentence. A
sentence has its document's label although few of its words are to blame, so
positive units are those with a character 4-gram that toxic documents hold far
more often than chance allows (a likelihood-ratio test); copies of them with
inserted characters join them, and other words are negative. The kernel to a
few hundred landmark units, whitened (Nystroem), feeds a linear SVM with
squared hinge loss; negatives that it gets wrong are added and it is fitted
again. The decision value is linear in the landmarks' triples, so it folds
into one weight per hashed triple and scoring needs no landmark.

A text scores by its three worst units, as a probability by a logistic curve
fitted to the labelled sample.

Defined results: null, empty and blank texts get the curve's value for no unit
at all; without toxic samples every score is 0; repeated rows score alike;
documents with several labels count once per label; other columns are ignored.
"""

from __future__ import annotations

import heapq
import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructType

from quarry.llm.common import Memo, PerWorker, bounded_sample, map_arrow, odd_multipliers, slices, splitmix
from quarry.llm.shingles import WordHashes, shingle_hashes
from quarry.session import materialize

GAP = 0.6
MAX_SPAN = 6
OFFSETS = [(j, k, GAP ** (k - 2)) for k in range(2, MAX_SPAN) for j in range(1, k)]
BITS = 21
UNIT_CHARS = 24           # longer units are cut into overlapping parts of this many characters
SAMPLE_DOCS = 12_000      # labelled documents, at most, of the training sample
SAMPLE_WORDS = 120_000    # most frequent units of the sample that training looks at
POSITIVES, NEGATIVES, LANDMARKS = 1_500, 6_000, 320
HARD_ROUNDS, HARD = 3, 2_000
PENALTY = 1e-5
SVM_ROWS = 1024           # examples that the SVM's sums take at a time
THRESHOLD = 0.7           # contract: predicted toxic from this score on
NO_UNIT = -3.0            # decision value in place of a missing unit
TOP = 3                   # units that make a text's score
MEMO_UNITS = 400_000

SENTENCE = re.compile(r"[.!?]+(?=\s)|\n")
SPELLED = re.compile(r"(?<!\S)\S(?:[ \t]+\S(?!\S)){2,}")
EDGES = ".,;:!?\"'()[]{}<>|#*$%&-_/\\`~^+="


def units(text: str) -> set[str]:
    """Distinct units of a text."""
    low = text.lower()
    found = set(low.split())
    for m in SPELLED.finditer(low):
        found.add("".join(m.group().split()))
    return found


def parts(unit: str) -> list[str]:
    """The unit without edge punctuation, between marks, in parts of bounded length that overlap by half."""
    word = unit.strip(EDGES)
    if not word:
        return []
    word = f"^{word}$"
    if len(word) <= UNIT_CHARS:
        return [word]
    return [word[i:i + UNIT_CHARS] for i in range(0, len(word) - UNIT_CHARS // 2, UNIT_CHARS // 2)]


def triples(words: list[str]) -> tuple[list[tuple[np.ndarray, np.ndarray, float]], np.ndarray]:
    """Hashed triples of each word (bucket matrix, validity, weight) and each word's norm."""
    longest = max(map(len, words))
    width = longest + MAX_SPAN
    text = "".join(w.ljust(width, "\0") for w in words)
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").reshape(len(words), width).astype(np.uint64)
    m = odd_multipliers(3, 53)
    first, mid, last = splitmix(codes * m[0]), splitmix(codes * m[1] + np.uint64(1)), splitmix(codes * m[2] + np.uint64(2))
    mid, last = mid * np.uint64(3), last * np.uint64(5)
    out, square = [], np.zeros(len(words))
    for j, k, weight in OFFSETS:
        n = max(1, longest - k)
        ok = codes[:, k:k + n] != 0
        h = first[:, :n] + mid[:, j:j + n] + last[:, k:k + n]
        out.append(((h >> np.uint64(64 - BITS)).astype(np.int32), ok, weight))
        square += weight * weight * ok.sum(axis=1)
    return out, np.sqrt(np.maximum(square, 1.0))


def by_length(words: list[str], rows: int):
    """Positions of words in blocks of similar length."""
    order = np.argsort([len(w) for w in words], kind="stable")
    for at in range(0, len(words), rows):
        yield order[at:at + rows]


def values(words: list[str], weights: np.ndarray) -> np.ndarray:
    """Sum of the weights of each word's triples, over its norm."""
    out = np.zeros(len(words))
    for block in by_length(words, 2048):
        found, norm = triples([words[i] for i in block])
        total = np.zeros(len(block))
        for h, ok, weight in found:
            total += weight * (weights[h] * ok).sum(axis=1)
        out[block] = total / norm
    return out


def kernel(words: list[str], landmarks: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Kernel values (words x landmarks), the buckets of the landmarks' triples, and the feature matrix of these."""
    found, norm = triples(landmarks)
    owner = np.arange(len(landmarks))[:, None]
    bucket = np.concatenate([h[ok] for h, ok, _ in found])
    column = np.concatenate([np.broadcast_to(owner, h.shape)[ok] for h, ok, _ in found])
    value = np.concatenate([np.full(int(ok.sum()), w) for _, ok, w in found]) / norm[column]
    used, row = np.unique(bucket, return_inverse=True)
    feature = np.zeros((len(used) + 1, len(landmarks)), np.float32)   # the last row is for triples of no landmark
    np.add.at(feature, (row, column), value)
    place = np.full(1 << BITS, len(used), np.int32)
    place[used] = np.arange(len(used))
    out = np.zeros((len(words), len(landmarks)))
    for block in by_length(words, 256):
        some, size = triples([words[i] for i in block])
        total = np.zeros((len(block), len(landmarks)))
        for h, ok, w in some:
            total += w * np.einsum("ij,ijk->ik", ok.astype(np.float32), feature[place[h]])
        out[block] = total / size[:, None]
    return out, used, feature[:-1]


def svm(z: np.ndarray, y: np.ndarray, cost: np.ndarray) -> np.ndarray:
    """Weights and offset (last) of a linear SVM with squared hinge loss, by Newton steps."""
    w = np.zeros(z.shape[1] + 1)
    ridge = PENALTY * np.eye(len(w))
    ridge[-1, -1] = 1e-9
    for _ in range(30):
        hess, grad = np.zeros_like(ridge), np.zeros_like(w)
        for at in range(0, len(z), SVM_ROWS):       # sums over blocks, so that no copy of all examples is made
            x = np.hstack([z[at:at + SVM_ROWS], np.ones((len(z[at:at + SVM_ROWS]), 1))])
            label, weight = y[at:at + SVM_ROWS], cost[at:at + SVM_ROWS]
            active = label * (x @ w) < 1
            a = x[active] * weight[active, None]
            hess += a.T @ x[active]
            grad += a.T @ label[active]
        new = np.linalg.solve(ridge + hess / cost.sum(), grad / cost.sum())
        if np.allclose(new, w, atol=1e-8):
            break
        w = new
    return w


def with_insertions(words: list[str]) -> list[str]:
    """Copies with a character put between all letters, or into the middle."""
    out = []
    for n, w in enumerate(words):
        inner = w[1:-1]
        if len(inner) >= 4:
            c = ".-*_"[n % 4]
            out.append(f"^{c.join(inner)}$"[:UNIT_CHARS])
            half = len(inner) // 2
            out.append(f"^{inner[:half]}{c}{inner[half:]}$"[:UNIT_CHARS])
    return out


def suspects(words: list[str], toxic: np.ndarray, clean: np.ndarray, n_toxic: int,
             n_clean: int) -> tuple[np.ndarray, list[int]]:
    """Which words hold a 4-gram that is tied to toxic documents beyond chance, and a word of each such gram."""
    grams: dict[str, list[int]] = {}
    for i, w in enumerate(words):
        for g in {w[k:k + 4] for k in range(max(1, len(w) - 3))}:
            grams.setdefault(g, []).append(i)
    base = n_toxic / (n_toxic + n_clean)
    needed = math.log(max(2, len(grams))) + 3
    found = np.zeros(len(words), bool)
    tied = []
    for members in grams.values():
        t, c = float(toxic[members].sum()), float(clean[members].sum())
        r = t / (t + c) if t else 0.0
        if r < max(0.6, 2 * base) or t < 3:
            continue
        gain = t * math.log(r / base) + (c * math.log((1 - r) / (1 - base)) if c else 0.0)
        if gain > needed:
            found[members] = True
            tied.append((gain, members))
    found &= (toxic > 0) & (clean <= 0.25 * toxic)
    typical = []
    for _, members in sorted(tied, key=lambda x: -x[0]):
        best = max((i for i in members if found[i]), key=lambda i: toxic[i], default=None)
        if best is not None:
            typical.append(best)
    return found, list(dict.fromkeys(typical))


def fit_words(counts: list[tuple[str, int, int]], n_toxic: int, n_clean: int) -> tuple[np.ndarray, float] | None:
    """Weight per hashed triple and offset, from (unit, toxic documents, clean documents)."""
    table: dict[str, list[int]] = {}
    for unit, t, c in counts:
        for p in parts(unit):
            seen = table.setdefault(p, [0, 0])
            seen[0] += t
            seen[1] += c
    words = sorted(table)
    toxic = np.array([table[w][0] for w in words], float)
    clean = np.array([table[w][1] for w in words], float)
    if not n_toxic or not n_clean or not words:
        return None
    table.clear()
    bad, typical = suspects(words, toxic, clean, n_toxic, n_clean)
    if not typical:
        return None
    positive = [i for i in np.argsort(-toxic, kind="stable") if bad[i]][:POSITIVES]
    plain = [i for i in np.argsort(-clean, kind="stable") if not bad[i] and clean[i] > 0]
    rest = plain[NEGATIVES // 2:]
    negative = plain[:NEGATIVES // 2] + rest[::max(1, 2 * len(rest) // NEGATIVES)]
    marks = [words[i] for i in typical[:LANDMARKS // 2]]
    marks += with_insertions(marks[:LANDMARKS // 8])
    marks += [words[i] for i in plain[:LANDMARKS // 4]] + [words[i] for i in rest[::max(1, 4 * len(rest) // LANDMARKS)]]
    landmarks = list(dict.fromkeys(marks))
    own, used, feature = kernel(landmarks, landmarks)
    value, vector = np.linalg.eigh((own + own.T) / 2)
    good = value > 1e-5 * value.max()
    white = vector[:, good] / np.sqrt(value[good])

    def example(indexes: list[int], weight: np.ndarray, sign: float, extra: bool = False):
        some = [words[i] for i in indexes]
        cost = np.sqrt(weight[indexes])
        z = [kernel(some, landmarks)[0] @ white]
        if extra:
            more = with_insertions(some)
            z.append(kernel(more, landmarks)[0] @ white if more else np.zeros((0, white.shape[1])))
            cost = np.concatenate([cost, np.full(len(more), cost.mean() / 2)])
        z = np.concatenate(z)
        return z, np.full(len(z), sign), cost

    z, y, cost = example(positive, toxic, 1.0, extra=True)
    come, known = negative, set(negative)
    for round_ in range(HARD_ROUNDS):
        if come:
            z2, y2, c2 = example(come, clean, -1.0)
            z, y, cost = np.concatenate([z, z2]), np.concatenate([y, y2]), np.concatenate([cost, c2])
        even = np.where(y > 0, cost / cost[y > 0].sum(), cost / cost[y < 0].sum())
        w = svm(z, y, even)
        weights = np.zeros(1 << BITS, np.float32)
        weights[used] = feature @ (white @ w[:-1])
        offset = float(w[-1])
        if round_ + 1 < HARD_ROUNDS:
            score = values([words[i] for i in plain], weights) + offset
            come = [plain[k] for k in np.argsort(-score)[:HARD] if score[k] > -1 and plain[k] not in known]
            known.update(come)
    return weights, offset


class Scorer:
    """The largest decision values of a text's units, with a memo of units."""

    def __init__(self, weights: np.ndarray, offset: float):
        self.weights, self.offset = weights, offset
        self.memo = Memo(MEMO_UNITS)

    def __call__(self, texts: list[str]) -> np.ndarray:
        """TOP values of each text, largest first."""
        found = [units(t) if t else set() for t in texts]
        new = self.memo.missing(set().union(*found))
        look = self.memo.young
        for at in range(0, len(new), 16_384):
            block = new[at:at + 16_384]
            cut = [parts(u) for u in block]
            flat = [p for c in cut for p in c]
            score = (values(flat, self.weights) + self.offset).tolist() if flat else []
            i = 0
            for u, c in zip(block, cut):
                look[u] = max(score[i:i + len(c)], default=NO_UNIT)
                i += len(c)
        none = [NO_UNIT] * TOP
        return np.array([(heapq.nlargest(TOP, [look[u] for u in f]) + none)[:TOP] for f in found]).reshape(-1, TOP)


def _counts(sample: DataFrame) -> DataFrame:
    """(unit, t, c): toxic and clean documents of the sample's most frequent units."""
    def run(batches):
        for b in slices(batches):
            for text, label in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                found = set().union(*(units(s) for s in SENTENCE.split(text or "")))
                yield pa.RecordBatch.from_arrays([pa.array(sorted(found), pa.string()),
                                                  pa.array([label] * len(found), pa.int32())], names=["unit", "toxic"])

    per = map_arrow(sample.select("text", "toxic"), run, "unit string, toxic int")
    return per.groupBy("unit").agg(F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("c")) \
        .orderBy(F.desc(F.col("t") + F.col("c")), F.xxhash64("unit"), "unit").limit(SAMPLE_WORDS)


def _fitted(sample: DataFrame) -> tuple[np.ndarray, float] | None:
    """``fit_words`` of the sample, in a task: the words and their kernel take no memory of the driver."""
    n = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n_toxic, n_clean = n.get(1, 0), n.get(0, 0)

    def run(batches):
        counts = []           # SAMPLE_WORDS at most
        for b in batches:
            counts += zip(*(c.to_pylist() for c in b.columns))
        model = fit_words(counts, n_toxic, n_clean)
        if model is not None:
            yield pa.RecordBatch.from_arrays([pa.array([model[0].tobytes()], pa.binary()), pa.array([model[1]], pa.float64())],
                                             names=["weights", "offset"])

    made = map_arrow(_counts(sample).repartition(1), run, "weights binary, offset double").collect()      # one row or none
    return (np.frombuffer(bytes(made[0].weights), np.float32), made[0].offset) if made else None


def curve(value: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Logistic regression of labels on the TOP values (offset last), with smoothed targets and even classes."""
    n1, n0 = label.sum(), (1 - label).sum()
    target = np.where(label > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    weight = np.where(label > 0, 1 / max(n1, 1), 1 / max(n0, 1))
    x = np.hstack([value, np.ones((len(value), 1))])
    w = np.zeros(x.shape[1])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (weight * (p - target)) + 1e-4 * w
        hess = (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + 1e-4 * np.eye(len(w))
        step = np.clip(np.linalg.solve(hess, grad), -2, 2)
        w -= step
        if np.abs(step).max() < 1e-7:
            break
    return w


def probability(value: np.ndarray, line: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(value @ line[:-1] + line[-1], -30, 30)))


def _valued(docs: DataFrame, keep: list[str], scorer: PerWorker, line: np.ndarray | None,
            name: str = "tox_score") -> DataFrame:
    """``keep`` columns, then the score as ``name``, or without ``line`` the TOP values as columns name0, name1, ..."""
    names = [name] if line is not None else [f"{name}{i}" for i in range(TOP)]

    def run(batches):
        score = scorer.get()
        for b in slices(batches):
            value = score(b.column(b.num_columns - 1).to_pylist())
            cols = [probability(value, line)] if line is not None else list(value.T)
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], *(pa.array(np.ascontiguousarray(c)) for c in cols)],
                                             names=[*keep, *names])

    schema = StructType([docs.schema[c] for c in keep])
    for n in names:
        schema = schema.add(n, DoubleType())
    return map_arrow(docs.select(*keep, F.col("text").cast("string").alias(name)), run, schema)


def train(docs: DataFrame, labels: DataFrame, bound: int = SAMPLE_DOCS) -> tuple[PerWorker, np.ndarray] | None:
    """Scorer and curve from texts and labels of learnable rows; None if nothing tells toxic texts apart."""
    sample = materialize(_without_copies(labelled(docs, labels, bound)), "toxic-sample")
    model = _fitted(sample)
    if model is None:
        return None
    scorer = PerWorker(docs.sparkSession, Scorer, *model)
    seen = _valued(sample, ["toxic"], scorer, None).toPandas()         # a few numbers for each sampled document
    return scorer, curve(seen.iloc[:, 1:].to_numpy(), seen["toxic"].to_numpy(float))


def scores(docs: DataFrame, model, keep: list[str], name: str = "tox_score") -> DataFrame:
    """``keep`` columns and the score as ``name``, which is none of them."""
    if model is None:
        return docs.select(*keep).withColumn(name, F.lit(0.0))
    return _valued(docs, keep, *model, name)


MINIMA = 4                # smallest shingle hashes by which near copies are known in the sample


def minima(text: str | None, hashes: WordHashes) -> list[int]:
    """Smallest hashes of the text's shingles under MINIMA hash functions."""
    shingles = shingle_hashes(hashes.of(text))
    if not len(shingles):
        return [0] * MINIMA
    return [int((shingles * m).min() >> np.uint64(1)) for m in odd_multipliers(MINIMA, 61)]


def _without_copies(sample: DataFrame) -> DataFrame:
    """The (text, toxic) sample without near copies, which would make their words look typical of a label."""
    shared = PerWorker(sample.sparkSession, WordHashes)

    def run(batches):
        hashes = shared.get()
        for b in slices(batches):
            low = np.array([minima(t, hashes) for t in b.column(0).to_pylist()], np.int64).reshape(-1, MINIMA)
            yield pa.RecordBatch.from_arrays([*b.columns, *(pa.array(c) for c in np.ascontiguousarray(low.T))],
                                             names=["text", "toxic", *(f"m{i}" for i in range(MINIMA))])

    columns = ", ".join(f"m{i} bigint" for i in range(MINIMA))
    out = map_arrow(sample.select("text", "toxic"), run, f"text string, toxic int, {columns}")
    for i in range(MINIMA):
        first = Window.partitionBy("toxic", f"m{i}").orderBy(F.xxhash64("text"))
        out = out.withColumn("rn", F.row_number().over(first)).filter("rn = 1").drop("rn")
    return out.select("text", "toxic")


def learnable() -> Column:
    """Rows whose label may be learnt: crc32(doc_id) mod 3 is not 1."""
    return ~F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))


def labelled(docs: DataFrame, labels: DataFrame, bound: int) -> DataFrame:
    """(text, toxic) of at most ``bound`` learnable rows.

    The labels are sampled first, so that they can be broadcast and no text
    is shuffled; where a sampled id has very many documents, these are
    sampled in turn.
    """
    known = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")) \
        .filter(learnable() & F.col("toxic").isin(0, 1)).dropDuplicates(["doc_id", "toxic"])
    some = F.broadcast(bounded_sample(known, "doc_id", bound, unique=True))      # two numbers for each of `bound` rows
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(some, "doc_id")
    n = docs.select("doc_id").join(some, "doc_id").count()
    return bounded_sample(rows, "doc_id", bound, n).select("text", "toxic")


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """op7: score and verdict of every document."""
    model = train(docs, labels)
    out = scores(docs.select("doc_id", "text"), model, ["doc_id"])
    return out.select("doc_id", (~learnable()).alias("held_out"), F.col("tox_score").alias("score"),
                      (F.col("tox_score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not predicted toxic, with all columns of ``docs``."""
    model = train(docs, labels)
    name = "_".join(["tox_score", *docs.columns])       # longer than any column's name
    return scores(docs, model, docs.columns, name).filter(F.col(name) < THRESHOLD).select(*docs.columns)
