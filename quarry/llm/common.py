"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.session import ship_package

SLICE_ROWS = 256        # rows turned into Python objects at a time inside a task
BATCH_BYTES = 8 << 20    # of an Arrow batch, so that long texts do not fill a worker


def map_arrow(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
              schema: str) -> DataFrame:
    """``mapInArrow`` with this package's functions shipped to the workers, in batches of bounded bytes."""
    ship_package()
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return df.mapInArrow(fn, schema)


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into small ones, so that only a few texts are Python objects at once."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def bounded_sample(df: DataFrame, key: str, bound: int, n_rows: int | None = None, seed: int = 7,
                   unique: bool = False) -> DataFrame:
    """About ``bound`` rows at most, chosen by a hash of ``key`` and, unless keys are ``unique``, of the row's
    place in the scan.

    Only classifiers are fitted on such samples. The place keeps a key that
    very many rows share from being taken whole.
    """
    n = df.count() if n_rows is None else n_rows
    if n <= bound:
        return df
    buckets = 1 << 30
    keep = max(1, int(buckets * bound / n))
    place = F.xxhash64(F.col(key), F.lit(0) if unique else F.monotonically_increasing_id(), F.lit(seed))
    return df.filter(F.pmod(place, F.lit(buckets)) < keep)


def splitmix(x: np.ndarray) -> np.ndarray:
    """Finalising mix of 64-bit integers (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def odd_multipliers(n: int, seed: int) -> np.ndarray:
    """``n`` random odd 64-bit multipliers, the same on every machine."""
    base = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed * 7919 + 1)
    return splitmix(base) | np.uint64(1)


def read_bytes(path: str) -> bytes:
    """A vocabulary file of the driver; operators broadcast its bytes (some MB at most)."""
    with open(path, "rb") as f:
        return f.read()


class Memo:
    """A bounded dictionary: two generations, of which the older is forgotten when the younger is full."""

    def __init__(self, size: int):
        self.size = size
        self.young: dict = {}
        self.old: dict = {}

    def missing(self, keys: set) -> list:
        """Keys without an entry; entries of the old generation that are asked for become young."""
        if len(self.young) >= self.size:
            self.old, self.young = self.young, {}
        new = []
        for k in keys:
            if k not in self.young:
                if k in self.old:
                    self.young[k] = self.old[k]
                else:
                    new.append(k)
        new.sort()
        return new


class PerWorker:
    """Handle of an object that each Python worker builds once and keeps for its later tasks.

    The recipe is broadcast in a dictionary; a worker process holds one copy of
    a broadcast value, so what a task puts there is found by the next task.
    """

    def __init__(self, spark: SparkSession, build: Callable, *args):
        ship_package()
        self.shared = spark.sparkContext.broadcast({"recipe": cloudpickle.dumps((build, args))})

    def get(self):
        held = self.shared.value
        if "made" not in held:
            build, args = cloudpickle.loads(held["recipe"])
            held["made"] = build(*args)
        return held["made"]
