"""Ranked runs on disk.

A run is ``(qid, pid, rank[, score])`` and always carries its rank as a
column: DataFrames have no row order. Parquet runs are range-partitioned by
``(qid, rank)``. Rank-less two-column TSV files (rank = line order) are read
by ordering lines by (file, block offset, position in the read) -- the file
order -- and numbering them per query.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

RUN_SCHEMA = "qid BIGINT, pid BIGINT, rank BIGINT, score DOUBLE"


def write_run(run: DataFrame, path: str, fmt: str = "parquet", n_files: int | None = None) -> None:
    spark = run.sparkSession
    n = n_files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    cols = [c for c in ("qid", "pid", "rank", "score") if c in run.columns]
    ordered = run.select(*cols).repartitionByRange(n, "qid", "rank").sortWithinPartitions("qid", "rank")
    if fmt == "parquet":
        ordered.write.mode("overwrite").parquet(path)
    elif fmt == "tsv":
        ordered.select(F.concat_ws("\t", *[F.col(c).cast("string") for c in cols]).alias("value")) \
            .write.mode("overwrite").text(path)
    elif fmt == "tsv2":
        # the two-column layout: rank is implied by line order within a query
        ordered.select(F.concat_ws("\t", F.col("qid").cast("string"), F.col("pid").cast("string"))
                       .alias("value")).write.mode("overwrite").text(path)
    else:
        raise ValueError(f"fmt must be 'parquet', 'tsv' or 'tsv2', got {fmt!r}")


def read_run(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    if fmt == "parquet":
        return spark.read.parquet(path)
    if fmt == "tsv":
        return spark.read.option("sep", "\t").schema(RUN_SCHEMA).csv(path)
    if fmt != "tsv2":
        raise ValueError(f"fmt must be 'parquet', 'tsv' or 'tsv2', got {fmt!r}")
    parts = F.split(F.col("value"), "\t")
    lines = (spark.read.text(path)
             .select(parts[0].cast("bigint").alias("qid"), parts[1].cast("bigint").alias("pid"),
                     F.regexp_extract("_metadata.file_path", "part-(\\d+)", 1).try_cast("bigint").alias("__part"),
                     F.col("_metadata.file_path").alias("__file"),
                     F.col("_metadata.file_block_start").alias("__block"),
                     F.monotonically_increasing_id().alias("__seq")))
    # a query's lines are at most the run depth: a bounded window group
    w = Window.partitionBy("qid").orderBy("__part", "__file", "__block", "__seq")
    return lines.select("qid", "pid", F.row_number().over(w).cast("bigint").alias("rank"))


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(hpath)


def table_print(df: DataFrame) -> str:
    """Fingerprint of a table: of its files' names, sizes and times where it is read from files, else of its rows.

    Names and times are read by a Spark job over the files' metadata; no file is opened. The rows' hashes are summed, so
    their order does not matter.
    """
    files = df.inputFiles()
    if files:
        rows = df.sparkSession.read.format("binaryFile").load(list(files)).select("path", "length", "modificationTime")
        what = "columns " + ",".join(df.columns)
    else:
        rows, what = df, "rows"
    h = F.xxhash64(*rows.columns) if rows.columns else F.lit(0)
    n, total = rows.agg(F.count(F.lit(1)), F.sum(h.cast("decimal(20,0)"))).first()
    return f"{what}:{n}:{total or 0}"


def run_manifest(inputs: dict[str, DataFrame], params: dict) -> dict[str, str]:
    """What a run was made from: a fingerprint of each input, and the parameters."""
    return {**{f"input {n}": table_print(df) for n, df in inputs.items()},
            **{f"parameter {n}": str(v) for n, v in params.items()}}


def write_manifest(spark: SparkSession, path: str, manifest: dict[str, str]) -> None:
    """Saved inside the run's folder, where readers of the run do not look; written after the run."""
    spark.createDataFrame(sorted(manifest.items()), "key string, value string").coalesce(1) \
        .write.mode("overwrite").parquet(f"{path}/_manifest")


def read_manifest(spark: SparkSession, path: str) -> dict[str, str] | None:
    if not path_exists(spark, f"{path}/_manifest/_SUCCESS"):
        return None
    return {r.key: r.value for r in spark.read.parquet(f"{path}/_manifest").collect()}


def load_or_build_run(spark: SparkSession, path: str, build: Callable[[], DataFrame],
                      inputs: dict[str, DataFrame] | None = None, params: dict | None = None) -> DataFrame:
    """Reuse the saved run at ``path``; build and save it if there is none.

    With ``inputs`` or ``params`` a run is reused only if its manifest says that it was made from the same tables and
    parameters; any other, and one without a manifest, is built anew.
    """
    manifest = run_manifest(inputs or {}, params or {}) if inputs is not None or params is not None else None
    saved = path_exists(spark, f"{path}/_SUCCESS")
    if not saved or (manifest is not None and read_manifest(spark, path) != manifest):
        write_run(build(), path, "parquet")
        if manifest is not None:
            write_manifest(spark, path, manifest)
    return read_run(spark, path, "parquet")
