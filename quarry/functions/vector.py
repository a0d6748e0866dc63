"""Vector column expressions (JVM higher-order functions, no Python).

Used where the number of pairs is already small (rerank of a truncated run,
scoring candidates inside an ANN cell). Bulk all-pairs scoring goes through
the Arrow/NumPy kernel in ``quarry.operators.knn``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def dot(a, b) -> Column:
    """Inner product of two equal-length float arrays, accumulated in double."""
    prods = F.zip_with(_col(a), _col(b), lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(prods, F.lit(0.0), lambda acc, v: acc + v)


def norm(a) -> Column:
    """Euclidean norm, accumulated in double."""
    return F.sqrt(F.aggregate(_col(a), F.lit(0.0),
                              lambda acc, x: acc + x.cast("double") * x.cast("double")))


def cosine(a, b) -> Column:
    """dot / (|a| |b|); a zero norm gives 0.0, never NULL or NaN."""
    den = norm(a) * norm(b)
    return F.when(den == F.lit(0.0), F.lit(0.0)).otherwise(dot(a, b) / den)
