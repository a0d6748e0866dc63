"""Subset and relevance filters: semi/anti joins and predicates only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def subset_by_ids(df: DataFrame, ids: DataFrame, id_col: str, ids_col: str | None = None) -> DataFrame:
    """Rows of ``df`` whose ``id_col`` occurs in ``ids`` (a left semi join).

    The id side is reduced to its key column first, so the join never
    widens ``df`` and duplicate ids cannot multiply rows.
    """
    ids_col = ids_col or id_col
    keys = ids.select(F.col(ids_col).alias(id_col))
    return df.join(keys, id_col, "left_semi")


def missing_ids(df: DataFrame, ids: DataFrame, id_col: str, ids_col: str | None = None) -> DataFrame:
    """Rows of ``df`` whose ``id_col`` does not occur in ``ids`` (a left anti join)."""
    ids_col = ids_col or id_col
    return df.join(ids.select(F.col(ids_col).alias(id_col)), id_col, "left_anti")


def judged_queries(qrels: DataFrame) -> DataFrame:
    """Distinct query ids that have at least one judgment (any grade)."""
    return qrels.select("qid").distinct()
