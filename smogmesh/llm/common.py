"""Shared helpers of the training-data operators: tables, scratch tables, byte arrays."""

from __future__ import annotations

import ctypes
import gc
import os
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from smogmesh.session import checkpoint_root, scratch_path

#: Odd multiplier of the rolling hash and its inverse modulo 2**64.
BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, name: str, **options) -> DataFrame:
    """``df`` written as parquet in the shared checkpoint folder and read back: cuts lineage."""
    spark = df.sparkSession
    checkpoint_root(spark)
    path = scratch_path(spark, name)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_CLEAN_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Within it, a job's shuffle files are deleted when the job ends.

    For jobs that write a table: nothing reads the shuffles again once it is there.
    Otherwise an operator of many rounds keeps those of all of them on the
    executors' disks until the driver happens to collect its garbage.  The
    session's own setting is put back.
    """
    before = spark.conf.get(_CLEAN_SHUFFLES, "false")
    spark.conf.set(_CLEAN_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEAN_SHUFFLES, before)


def tidily_written(df: DataFrame, name: str) -> DataFrame:
    """``written``, with the shuffle files of the job deleted when it ends."""
    with shuffles_removed(df.sparkSession):
        return written(df, name)


_KEPT: dict[str, dict] = {}


def kept(owner: str) -> dict:
    """What tasks of the operator ``owner`` keep for one another in a worker process.

    Spark hands a process on from one operator's tasks to another's.  What others
    kept (tokenizers and their units: some 200 MB) is dropped, and its memory
    given back to the system where the C library can.
    """
    others = [name for name in _KEPT if name != owner]
    if others:
        for name in others:
            del _KEPT[name]
        gc.collect()
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim:
            trim(0)
    return _KEPT.setdefault(owner, {})


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over all 64 (vectorised, wraps)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def byte_codes() -> np.ndarray:
    """A 64-bit code per byte value, from the mixer: what the rolling hash sums."""
    return mix64(np.arange(1, 257, dtype=np.uint64) * BASE)


class Powers:
    """Powers of ``BASE`` and of its inverse, grown on demand."""

    def __init__(self) -> None:
        self.up = np.ones(1, dtype=np.uint64)
        self.down = np.ones(1, dtype=np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up))
            step = np.full(size, BASE, dtype=np.uint64)
            step[0] = 1
            self.up = np.cumprod(step, dtype=np.uint64)
            step[1:] = BASE_INV
            self.down = np.cumprod(step, dtype=np.uint64)
        return self.up, self.down


POWERS = Powers()


def prefix_sums(data: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """``S`` with ``S[j] - S[i]`` the weighted code sum of ``data[i:j]`` (see ``span_hash``)."""
    up, _ = POWERS.upto(len(data) + 1)
    s = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(codes[data] * up[: len(data)], dtype=np.uint64, out=s[1:])
    return s


def span_hash(s: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of ``data[start:end]``: depends on the bytes only, not on where they lie."""
    _, down = POWERS.upto(len(s))
    return mix64((s[end] - s[start]) * down[start] + (end - start).astype(np.uint64))


def text_batches(batch: pa.RecordBatch, column: str, max_bytes: int):
    """Split a batch into row ranges ``(lo, hi)`` of at most ``max_bytes`` text bytes (or one row)."""
    col = batch.column(column)
    lo, size = 0, 0
    for i in range(batch.num_rows):
        v = col[i]
        n = len(v.as_buffer()) if v.is_valid else 0
        if i > lo and size + n > max_bytes:
            yield lo, i
            lo, size = i, 0
        size += n
    if batch.num_rows > lo:
        yield lo, batch.num_rows


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


class Generations:
    """Scratch tables of an iteration: each ``keep`` writes the next one and deletes those but the last two.

    A round reads only the table of the round before it, so an older one is
    needed by nobody, a task that runs again included.
    """

    def __init__(self, spark: SparkSession, name: str):
        checkpoint_root(spark)
        self.spark, self.name, self.paths = spark, name, []

    def keep(self, df: DataFrame) -> DataFrame:
        path = scratch_path(self.spark, self.name)
        df.write.parquet(path)
        self.paths.append(path)
        while len(self.paths) > 2:
            discard(self.spark, self.paths.pop(0))
        return self.spark.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder in the store that holds it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def drop_written(*tables: DataFrame) -> None:
    """Delete the folders of tables that ``written`` gave and nothing reads any more."""
    for df in tables:
        files = df.inputFiles()
        if files:
            discard(df.sparkSession, files[0].rsplit("/", 1)[0])
