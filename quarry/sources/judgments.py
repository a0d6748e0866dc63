"""Relevance-judgment files.

Two layouts: ``triples`` (qid, pid, rel) and ``trec`` (qid, 0, pid, rel) whose
constant second column is dropped. The layout is an explicit argument, never
guessed from the file name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMAS = {
    "triples": "qid BIGINT, pid BIGINT, rel INT",
    "trec": "qid BIGINT, iter INT, pid BIGINT, rel INT",
}


def read_qrels(spark: SparkSession, path: str, fmt: str = "triples",
               validate: bool = False) -> DataFrame:
    if fmt not in SCHEMAS:
        raise ValueError(f"fmt must be one of {sorted(SCHEMAS)}, got {fmt!r}")
    df = (spark.read.option("sep", "\t").option("header", "false").option("mode", "FAILFAST")
          .schema(SCHEMAS[fmt]).csv(path).select("qid", "pid", "rel"))
    return checked_unique(df) if validate else df


def checked_unique(qrels: DataFrame) -> DataFrame:
    """Fail the job if a (qid, pid) pair is judged twice.

    A duplicate would be counted twice in recall/AP denominators and make the
    NDCG grade ambiguous. The check runs inside the job that uses the
    judgments (``raise_error`` on a per-pair count), not as a separate action.
    """
    counted = qrels.groupBy("qid", "pid").agg(F.count(F.lit(1)).alias("__n"), F.max("rel").alias("rel"))
    return counted.select(
        "qid", "pid",
        F.when(F.col("__n") > 1, F.raise_error(F.concat(
            F.lit("duplicate judgment for (qid, pid) = ("), F.col("qid").cast("string"), F.lit(", "),
            F.col("pid").cast("string"), F.lit(")")))).otherwise(F.col("rel")).cast("int").alias("rel"))


def write_qrels(qrels: DataFrame, path: str, fmt: str = "triples") -> None:
    cols = [F.col("qid"), F.col("pid"), F.col("rel")]
    if fmt == "trec":
        cols = [F.col("qid"), F.lit(0), F.col("pid"), F.col("rel")]
    elif fmt != "triples":
        raise ValueError(f"fmt must be 'triples' or 'trec', got {fmt!r}")
    (qrels.select(F.concat_ws("\t", *[c.cast("string") for c in cols]).alias("value"))
     .write.mode("overwrite").text(path))
