"""``id<TAB>text`` files (passages and queries).

Read with the line reader and split at the *first* tab only: the CSV reader
would strip a leading quote and cut the text at a second tab. Lines end at
``\\n`` alone, so a bare carriage return stays inside its text. Writing
replaces line breaks inside the text by a space (one record per line) and a
null text by an empty one; tabs stay, and a reader keeps everything after the
first tab as text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """(value, id, text): id is null where the line has no tab after a 64-bit integer."""
    value = F.regexp_replace("value", "\r$", "")    # files with CRLF line ends
    parts = F.split(F.col("value"), "\t", 2)
    return (spark.read.text(path, lineSep="\n").select(value.alias("value"))
            .select("value", F.when(F.size(parts) == 2, parts[0].try_cast("bigint")).alias("id"),
                    F.get(parts, F.lit(1)).alias("text")))


def count_bad_lines(spark: SparkSession, path: str) -> int:
    """Lines that are no record: no tab, or no 64-bit integer before it."""
    return _lines(spark, path).where(F.col("id").isNull()).count()


def read_id_text_tsv(spark: SparkSession, path: str, id_name: str = "id", text_name: str = "text",
                     on_bad: str = "error") -> DataFrame:
    """(id, text) records.

    A line that is no record fails the job that reads it, naming the line
    (``on_bad='error'``), or is left out (``'drop'``; ``count_bad_lines``
    tells how many there are).
    """
    if on_bad not in ("error", "drop"):
        raise ValueError(f"on_bad must be 'error' or 'drop', got {on_bad!r}")
    lines = _lines(spark, path)
    number = F.col("id")
    if on_bad == "drop":
        lines = lines.where(number.isNotNull())
    else:
        message = F.concat(F.lit("not an id<TAB>text line: "), F.substring("value", 1, 100))
        number = F.when(number.isNotNull(), number).otherwise(F.raise_error(message).cast("bigint"))
    return lines.select(number.alias(id_name), F.col("text").alias(text_name))


def tsv_safe(text) -> Column:
    """Text as it survives a one-record-per-line file: CR/LF become spaces, null becomes empty."""
    col = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.regexp_replace(col, "[\\r\\n]", " "), F.lit(""))


def write_id_text_tsv(df: DataFrame, path: str, id_col: str = "id", text_col: str = "text") -> None:
    (df.select(F.concat_ws("\t", F.col(id_col).cast("string"), tsv_safe(text_col)).alias("value"))
     .write.mode("overwrite").text(path))
