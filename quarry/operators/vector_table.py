"""Vectors placed by id, for lookups of few ids in a large table.

The table is split into directories by a hash of the id, and within them
bucketed and sorted by id. A lookup joins on (directory, id): a broadcast head
prunes the scan to the directories that its ids fall in, at run time, and a
head that is too large for that is shuffled to the buckets. The vectors
themselves never are.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.session import BROADCAST_BYTES, bounded_broadcast, default_buckets, scratch_path

DIRECTORIES = 64


@dataclass
class VectorTable:
    spark: SparkSession
    path: str
    directories: int
    buckets: int
    kind: str

    @staticmethod
    def _place(column: str, n: int) -> F.Column:
        return F.pmod(F.xxhash64(F.col(column).cast("bigint"), F.lit(3)), F.lit(n)).cast("int")

    @property
    def _name(self) -> str:
        return "quarry_vectors_" + hashlib.sha1(self.path.encode()).hexdigest()[:16]

    @classmethod
    def write(cls, vectors: DataFrame, path: str | None = None, directories: int = DIRECTORIES,
              buckets: int | None = None) -> "VectorTable":
        """Place ``vectors(id, embedding)`` at ``path``: one exchange by id, a file for each bucket and directory."""
        if directories <= 0 or (buckets is not None and buckets <= 0):
            raise ValueError("directories and buckets must be positive")
        spark = vectors.sparkSession
        path = path or scratch_path(spark, "vector-table")
        table = cls(spark, path, directories, buckets or max(1, default_buckets(vectors) // 4),
                    vectors.schema["embedding"].dataType.simpleString())
        spark.sql(f"DROP TABLE IF EXISTS {table._name}")
        vectors.select(F.col("id").cast("bigint").alias("id"), "embedding") \
            .withColumn("directory", cls._place("id", directories)).repartition(table.buckets, "id") \
            .write.partitionBy("directory").bucketBy(table.buckets, "id").sortBy("id").mode("overwrite") \
            .option("path", f"{path}/vectors").saveAsTable(table._name)
        spark.createDataFrame([(directories, table.buckets, table.kind)], "directories int, buckets int, kind string") \
            .coalesce(1).write.mode("overwrite").parquet(f"{path}/params")
        return table

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "VectorTable":
        p = spark.read.parquet(f"{path}/params").first()
        return cls(spark, path, p.directories, p.buckets, p.kind)

    def table(self) -> DataFrame:
        """(id, embedding, directory) as a bucketed table of the session's catalog."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self._name}")
        self.spark.sql(f"CREATE TABLE {self._name} (id BIGINT, embedding {self.kind}, directory INT) USING parquet "
                       f"PARTITIONED BY (directory) CLUSTERED BY (id) SORTED BY (id) INTO {self.buckets} BUCKETS "
                       f"LOCATION '{self.path}/vectors'")
        self.spark.catalog.recoverPartitions(self._name)
        return self.spark.table(self._name)

    def lookup(self, head: DataFrame, key: str = "pid", out: str = "embedding",
               broadcast_bytes: int | None = BROADCAST_BYTES) -> DataFrame:
        """``head`` with the vector of its ``key``; rows whose key has none are dropped."""
        # always true, but a comparison: the planner prunes partitions at run time for filtered heads only
        placed = head.withColumn("directory", self._place(key, self.directories)).where(F.col("directory") >= 0)
        small = bounded_broadcast(placed, broadcast_bytes)
        stored = self.table().select("directory", F.col("id").alias(key), F.col("embedding").alias(out))
        return stored.join(small, ["directory", key]).drop("directory")
