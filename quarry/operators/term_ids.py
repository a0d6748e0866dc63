"""Dense integer ids for a sorted vocabulary, and postings that carry them.

Two passes over range partitions give the prefix sum: the distinct terms are
written in ranges of byte order, each row with its range's number; the ranges'
sizes, one row each, are summed up on the driver; a term's id is its range's
offset and its place in the range. No window and no task spans more than a
range, and ids follow byte order over the whole vocabulary.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.session import materialize


def term_ids(tf: DataFrame) -> DataFrame:
    """(term, term_id): the distinct terms of ``tf``, numbered from 0 in byte order; null terms have no id."""
    ranged = tf.select("term").filter("term is not null").distinct().repartitionByRange("term")
    written = materialize(ranged.withColumn("part", F.spark_partition_id()), "term-ranges")
    offset, offsets = 0, []
    for r in written.groupBy("part").count().orderBy("part").collect():      # one row for each range
        offsets.append((r.part, offset))
        offset += r["count"]
    starts = written.sparkSession.createDataFrame(offsets, "part int, start bigint")
    place = F.row_number().over(Window.partitionBy("part").orderBy("term")) - 1
    return written.withColumn("place", place).join(F.broadcast(starts), "part") \
        .select("term", (F.col("start") + F.col("place")).alias("term_id"))


def with_term_ids(postings: DataFrame, ids: DataFrame) -> DataFrame:
    """``postings`` with ``term_id`` in place of ``term``; map-side partial joins and skew splitting are the planner's."""
    return postings.join(ids, "term").drop("term")
