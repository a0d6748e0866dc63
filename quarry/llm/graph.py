"""Connected components of an edge table, in Spark jobs only.

Alternating large-star and small-star steps: each step gives every node the
smallest node of its neighbourhood as its new neighbour, until all components
are stars around their smallest node (a logarithmic number of rounds in
practice). A step is an aggregation with map-side combining and a join, so a
node with very many edges is neither collected nor a bottleneck: the join's
skewed partitions are split at run time. Every round is written to the shared
folder, which cuts the lineage and survives lost executors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.session import materialize

MAX_ROUNDS = 60


def _star(sym: DataFrame) -> DataFrame:
    """(u, v, m): edges with the smallest neighbour of u, u itself included."""
    least = sym.groupBy("u").agg(F.min("v").alias("m"))
    return sym.join(least, "u").withColumn("m", F.least("u", "m"))


def components(edges: DataFrame) -> DataFrame:
    """(node, root): for every node of ``edges(u, v)`` the smallest node reachable.

    Self-loops and repeated edges are allowed; an empty table gives no rows.
    """
    both = F.col("u") != F.col("v")
    flip = lambda e: e.select(F.col("v").alias("u"), F.col("u").alias("v"))
    now = materialize(edges.select("u", "v").filter(both).select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    state = None
    for _ in range(MAX_ROUNDS):
        large = _star(now.unionByName(flip(now))).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        stars = _star(large.distinct())
        small = stars.filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")) \
            .unionByName(stars.select("u", F.col("m").alias("v")))
        now = materialize(small.distinct(), "edges")
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if tuple(mark) == state:
            break
        state = tuple(mark)
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")) \
        .unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
