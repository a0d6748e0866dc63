"""Column expressions for tokenising and scoring text (all JVM-side).

Tokens are maximal runs of ASCII letters and digits; every other character,
including each non-ASCII letter, separates tokens. Matching is case-sensitive:
no lower-casing, stemming or stop words.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the studied system for identical results.
TOKEN_PATTERN = "[A-Za-z0-9]+"
BM25_K1 = 1.2
BM25_B = 0.75
IMPACT_MAX = 30.0      # scores are clamped to [0, 30] before quantising
IMPACT_LEVELS = 255    # ... and mapped linearly onto 0..255


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tokens(text) -> Column:
    """Document tokenizer: array of tokens in text order, repeats kept."""
    return F.regexp_extract_all(_col(text), F.lit(TOKEN_PATTERN), 0)


def query_tokens(text) -> Column:
    """Query tokenizer: distinct tokens (query term frequency is ignored)."""
    return F.array_distinct(tokens(text))


def idf(n_docs, df) -> Column:
    """ln((N - n + 0.5) / (n + 0.5)); negative when a term is in > N/2 docs."""
    n, d = _col(n_docs).cast("double"), _col(df).cast("double")
    return F.log((n - d + F.lit(0.5)) / (d + F.lit(0.5)))


def bm25_tf(tf, doc_len, avg_len, k1: float = BM25_K1, b: float = BM25_B) -> Column:
    """Saturated term frequency; 0 where the mean length is 0 (the length ratio is then infinite)."""
    t = _col(tf).cast("double")
    ratio = F.try_divide(_col(doc_len).cast("double"), _col(avg_len).cast("double"))
    norm = F.lit(k1) * (F.lit(1.0 - b) + F.lit(b) * ratio)
    return F.coalesce((F.lit(k1 + 1.0) * t) / (norm + t), F.lit(0.0))


def bm25_impact(tf, df, doc_len, n_docs, avg_len,
                k1: float = BM25_K1, b: float = BM25_B) -> Column:
    """BM25 weight of one (term, document) posting."""
    return idf(n_docs, df) * bm25_tf(tf, doc_len, avg_len, k1, b)


def quantize(score, hi: float = IMPACT_MAX, levels: int = IMPACT_LEVELS) -> Column:
    """8-bit linear quantiser: <=0 -> 0, >=hi -> levels, else truncate(s/hi*levels)."""
    s = _col(score)
    return (F.when(s <= F.lit(0.0), F.lit(0))
            .when(s >= F.lit(hi), F.lit(levels))
            .otherwise(F.floor(s / F.lit(hi) * F.lit(float(levels))).cast("int")))


def dequantize(q, hi: float = IMPACT_MAX, levels: int = IMPACT_LEVELS) -> Column:
    """Score of a quantised impact (or of a sum of them): q * hi / levels."""
    return _col(q).cast("double") * F.lit(hi) / F.lit(float(levels))


def mean_length(total, n_docs, avg_mode: str = "floor") -> Column:
    """Mean document length: truncated to an integer (``'floor'``) or real (``'exact'``); NULL without documents."""
    t, n = _col(total), F.nullif(_col(n_docs), F.lit(0))
    if avg_mode == "floor":
        return F.call_function("div", t, n).cast("double")
    if avg_mode == "exact":
        return t.cast("double") / n
    raise ValueError(f"avg_mode must be 'floor' or 'exact', got {avg_mode!r}")


def term_bucket(term, n_buckets: int) -> Column:
    """Directory bucket of a term in a saved index: pmod(xxhash64(term), n)."""
    return F.pmod(F.xxhash64(_col(term)), F.lit(n_buckets)).cast("int")
