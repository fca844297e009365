"""Helpers shared by the operators: reading, scratch tables, Arrow batches."""

from __future__ import annotations

import os
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from ledgerlens.session import scratch_path

# Bytes of text that one numpy pass holds at a time (memory bound of a worker).
SLICE_BYTES = 2 << 20
# Bytes of an Arrow batch on its way to a worker: whole texts may be long.
BATCH_SETTING, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 8 << 20
# Shuffle files go when the query that made them ends: ``written`` tables replace them.
SHUFFLE_SETTING = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Bound the batches that Python workers get and free shuffle files early,
    unless the deployer has set this otherwise, and let local workers import this package wherever the session was started
    from; on a cluster the package is installed or sent by --py-files."""
    if spark.conf.get(BATCH_SETTING, None) is None:
        spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))
    if spark.conf.get(SHUFFLE_SETTING, None) is None:
        spark.conf.set(SHUFFLE_SETTING, "true")
    sc = spark.sparkContext
    if sc.master.startswith("local"):
        root = str(Path(__file__).resolve().parents[2])
        known = [p for p in sc.environment.get("PYTHONPATH", "").split(os.pathsep) if p]
        if root not in known:
            sc.environment["PYTHONPATH"] = os.pathsep.join([root, *known])


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet under the shared folder and read back: its
    lineage ends there, so a lost executor never repeats the work before it."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges (lo, hi) of a batch holding about ``limit`` bytes of text each
    (one row at least)."""
    n = batch.num_rows
    if not n:
        return
    ends = np.cumsum(np.asarray(pc.binary_length(batch.column(column)).fill_null(0), dtype=np.int64) + 1)
    lo = 0
    while lo < n:
        before = ends[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield lo, min(hi, n)
        lo = hi


def flat_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts of a string array as one uint8 array and their bounds
    (length n + 1); nulls are empty texts."""
    arr = pc.fill_null(column.cast(pa.large_string()), "")
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    offsets = np.frombuffer(arr.buffers()[1], dtype=np.int64, count=len(arr) + 1 + arr.offset)[arr.offset :]
    data = arr.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (multiply and xor-shift) over uint64 values."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))
