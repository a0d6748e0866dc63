"""Secrets in texts: fixed patterns, and random-looking strings by character Markov models.

The base patterns give spans of three kinds. Two first-order Markov models of
characters are trained on labelled samples: strings that a base pattern
matched (random) and the rest of the same texts (ordinary identifiers and
words). A long run of token characters outside the base spans becomes a span
of kind ``random`` if its log-likelihood ratio favours the random model
clearly, in total and per character. The training sample is bounded; with few
matches in it, add-one smoothing makes the random model uniform.

Defined results: null and empty texts have no spans (the digest is that of "");
repeated rows are scanned alike; other columns are ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import bounded_sample, map_arrow, slices

# fixed values: the contract's patterns and least lengths
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")       # runs of [0-9a-f]+ that are long enough
ASSIGN_LEAST, ACCESS_LEAST = 12, 18
KINDS = ("assign", "access", "hex", "random")

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
SYMBOLS = len(ALPHABET)
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
SAMPLE_DOCS = 20_000     # documents the models are trained on, at most
LEAST_TOTAL = 16.0       # log-likelihood ratio of a random string ...
LEAST_MEAN = 0.8         # ... and its mean per transition

_LUT = np.full(256, 255, np.uint8)
_LUT[np.frombuffer(ALPHABET.encode(), np.uint8)] = np.arange(SYMBOLS, dtype=np.uint8)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the base patterns, in order."""
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_LEAST]
    spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(spans)


def transitions(text: str) -> np.ndarray:
    """Counts of neighbouring alphabet characters (flat SYMBOLS x SYMBOLS)."""
    s = _LUT[np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)].astype(np.int64)
    both = (s[:-1] < SYMBOLS) & (s[1:] < SYMBOLS)
    return np.bincount(s[:-1][both] * SYMBOLS + s[1:][both], minlength=SYMBOLS * SYMBOLS)


def train(docs: DataFrame, bound: int = SAMPLE_DOCS) -> np.ndarray:
    """Log-likelihood ratio (random over ordinary) of each transition, from at most ``bound`` documents."""
    def run(batches):
        total = np.zeros((2, SYMBOLS * SYMBOLS), np.int64)
        for b in slices(batches):
            for t in b.column(0).to_pylist():
                at, rest = 0, []
                for start, kind, end in base_spans(t or ""):
                    value = t[start:end] if kind else ASSIGN.match(t, start).group(2)
                    total[1] += transitions(value)
                    rest.append(t[at:start])
                    at = max(at, end)
                total[0] += transitions(" ".join([*rest, (t or "")[at:]]))
        label, pair = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(label.astype(np.int32)), pa.array(pair.astype(np.int32)),
                                          pa.array(total[label, pair])], names=["label", "pair", "n"])

    counted = map_arrow(bounded_sample(docs, "doc_id", bound, docs.select("doc_id").count()).select(F.col("text").cast("string")), run,
                        "label int, pair int, n bigint").groupBy("label", "pair").agg(F.sum("n").alias("n")).collect()
    counts = np.ones((2, SYMBOLS * SYMBOLS))
    for r in counted:                      # at most 2 * SYMBOLS ** 2 rows
        counts[r["label"], r["pair"]] += r["n"]
    counts = counts.reshape(2, SYMBOLS, SYMBOLS)
    log = np.log(counts / counts.sum(axis=2, keepdims=True))
    return log[1] - log[0]


def random_spans(text: str, ratio: np.ndarray, taken: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Spans of random-looking runs; of a run that meets spans in ``taken`` (in order), the parts outside them."""
    found, next_taken, covered = [], 0, 0
    for m in CANDIDATE.finditer(text):
        s = _LUT[np.frombuffer(m.group().encode(), np.uint8)]
        score = float(ratio[s[:-1], s[1:]].sum())
        if score < LEAST_TOTAL or score < LEAST_MEAN * (len(s) - 1):
            continue
        while next_taken < len(taken) and taken[next_taken][0] <= m.start():
            covered = max(covered, taken[next_taken][2])
            next_taken += 1
        at = max(m.start(), min(covered, m.end()))
        while next_taken < len(taken) and taken[next_taken][0] < m.end():
            start, _, end = taken[next_taken]
            if at < start:
                found.append((at, 3, start))
            covered = max(covered, end)
            at = max(at, min(covered, m.end()))
            next_taken += 1
        if at < m.end():
            found.append((at, 3, m.end()))
    return found


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{z}" for a, k, z in spans)


def scan(docs: DataFrame, ratio: np.ndarray | None = None) -> DataFrame:
    """op4: counts and digest of the base spans, and all spans, of every document."""
    ratio = train(docs) if ratio is None else ratio

    def run(batches):
        for b in slices(batches):
            out = [[], [], [], [], []]
            for t in b.column(1).to_pylist():
                base = base_spans(t or "")
                for k in range(3):
                    out[k].append(sum(x[1] == k for x in base))
                out[3].append(hashlib.sha256(joined(base).encode()).hexdigest())
                out[4].append(joined(sorted(base + random_spans(t or "", ratio, base))))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array(x, pa.int64()) for x in out[:3]), *(pa.array(x, pa.string()) for x in out[3:])],
                names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_arrow(docs.select("doc_id", F.col("text").cast("string")), run,
                     f"doc_id {kind}, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string")


def masked(text: str, spans: list[tuple[int, int, int]], mark: str) -> str:
    """The text with each stretch of spans replaced by ``mark``."""
    out, at = [], 0
    for start, _, end in spans:
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, mark: str = "[SECRET]", ratio: np.ndarray | None = None) -> DataFrame:
    """``docs`` with every secret replaced by ``mark``; ``n_chars``, where present, follows the new text."""
    ratio = train(docs) if ratio is None else ratio
    at = docs.columns.index("text")

    def run(batches):
        for b in slices(batches):
            new = []
            for t in b.column(at).to_pylist():
                spans = base_spans(t or "")
                spans = sorted(spans + random_spans(t or "", ratio, spans))
                new.append(masked(t, spans, mark) if spans else t)
            yield b.set_column(at, b.schema.field(at), pa.array(new, b.schema.field(at).type))

    out = map_arrow(docs, run, docs.schema)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), F.length("text"))
                             .cast(docs.schema["n_chars"].dataType))
    return out
