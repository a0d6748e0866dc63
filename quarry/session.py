"""Spark session construction and the shared scratch location.

Everything that has to be written between two jobs (round trips, saved
indexes, cut lineage) goes below ``spark.checkpoint.dir``: on a cluster that
setting names a shared file system, so files survive executor loss and every
executor sees them. A private default is set only when the session has none
(local tests).
"""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Arrow batches for mapInPandas kernels (vector blocks): bounded rows.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "4096",
}


def get_session(master: str | None = None, app: str = "quarry",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with AQE and skew handling on."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a private one only if unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="quarry-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared checkpoint folder; deleted when the driver ends."""
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/quarry-scratch-{spark.sparkContext.applicationId}"
    if base not in _SCRATCH:
        _SCRATCH.add(base)
        atexit.register(_delete, spark, base)
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


_SCRATCH: set[str] = set()


def _delete(spark: SparkSession, path: str) -> None:
    """Remove a folder of this session, through Spark's file systems."""
    sc = spark.sparkContext
    if sc._jsc is None:      # already stopped
        return
    hpath = sc._jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(sc._jsc.hadoopConfiguration()).delete(hpath, True)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below the shared checkpoint folder and read it back.

    Used where two branches of a plan must see the very same rows (e.g. a
    sampled range partitioning): the written copy is deterministic and
    survives executor loss, unlike a recomputation or a local checkpoint.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)    # a known schema: no job to infer it


def default_buckets(source: DataFrame, n_bytes: int = 0, bucket_bytes: int = 1) -> int:
    """Bucket count of a table written from ``source``: one per split of it, two per core at least.

    A bucketed scan has one task per bucket, so the count follows the data,
    and the cluster where the data are small; capped at Spark's bucket limit.
    Where the bytes of the source are known, buckets hold about ``bucket_bytes`` of them at most.
    """
    spark = source.sparkSession
    cap = int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets", "100000"))
    return max(1, min(cap, max(2 * spark.sparkContext.defaultParallelism, source.rdd.getNumPartitions(),
                           -(-n_bytes // bucket_bytes))))


BROADCAST_BYTES = 64 << 20   # largest table that is broadcast; beyond, joins shuffle
ROW_BYTES = 32               # counted for each row besides its values


def bounded_broadcast(df: DataFrame, max_bytes: int | None = BROADCAST_BYTES) -> DataFrame:
    """``df`` with a broadcast hint if a count of its bytes shows at most ``max_bytes``.

    Computes ``df`` once more, so it should be small or written. ``None`` or a
    table beyond the bound leave the join to the planner.
    """
    if max_bytes is None:
        return df
    width = F.lit(ROW_BYTES)
    for c in df.columns:
        width = width + F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0))
    size = df.agg(F.sum(width.cast("bigint"))).first()[0] or 0
    return F.broadcast(df) if size <= max_bytes else df


ARROW_BYTES = 8 << 20        # of a batch that a Python function gets


def map_bounded(df: DataFrame, fn, schema) -> DataFrame:
    """``mapInArrow`` with this package shipped to the workers, in batches of bounded bytes."""
    ship_package()
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)
    return df.mapInArrow(fn, schema)


def ship_package() -> None:
    """Make the library's Python kernels importable on every worker.

    Functions of this package are pickled by value, so Python workers need
    no copy of the package on their path (the same effect as ``--py-files``,
    without a separate deployment step). Idempotent.
    """
    import sys

    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(sys.modules["quarry"])


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")
