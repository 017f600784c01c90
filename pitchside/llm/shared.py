"""Files that the driver and all executors see, and small helpers for Arrow batches.

The folder is the one the cluster names in ``spark.checkpoint.dir``. Lineage is cut by writing a
Parquet table there and reading it back, so a lost executor costs only its running tasks.
"""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession

from .. import store
from ..store import remove as remove


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder's URI below ``spark.checkpoint.dir``, with the file system that it is in."""
    return store.folder(spark, name)


def release(spark: SparkSession) -> None:
    """Deletes what this driver has put in the shared folder. Results that still read it must have been written before."""
    store.release(spark)


CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialise(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """The same rows, read from a Parquet table in the shared folder. The shuffle files that this took go at once."""
    spark, path = df.sparkSession, shared_dir(df.sparkSession, name)
    before = spark.conf.get(CLEAN, None)
    spark.conf.set(CLEAN, "true")
    try:
        df.write.option("compression", codec).parquet(path)
    finally:
        spark.conf.unset(CLEAN) if before is None else spark.conf.set(CLEAN, before)
    return spark.read.schema(df.schema).parquet(path)


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system and path of a URI, on the driver as on executors. Hadoop's names for S3 are those of one store."""
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    if uri.startswith(("s3a://", "s3n://")):
        uri = "s3" + uri[3:]
    return pafs.FileSystem.from_uri(uri)


def write_file(uri: str, data: bytes) -> None:
    """Writes beside the target and renames, so that no reader meets half a file and a repeated task may write again."""
    at, path = filesystem(uri)
    at.create_dir(path.rpartition("/")[0], recursive=True)
    part = f"{path}.{uuid.uuid4().hex}.part"
    with at.open_output_stream(part, compression=None) as out:
        out.write(data)
    at.move(part, path)


def partitions(spark: SparkSession, least: int = 1) -> int:
    return max(least, int(spark.conf.get("spark.sql.shuffle.partitions")))


def raw(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """UTF-8 bytes of a string column; null gives b""."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [x or b"" for x in column.view(kind).to_pylist()]


def lean() -> None:
    """Arrow's own allocator keeps what is freed; the system's gives it back."""
    pa.set_memory_pool(pa.system_memory_pool())


def trim() -> None:
    """Gives freed memory back, as the worker may idle for long beside other stages."""
    gc.collect()
    if hasattr(ctypes.CDLL(None), "malloc_trim"):
        ctypes.CDLL(None).malloc_trim(0)


def small(batches: Iterator[pa.RecordBatch], most: int = 16 << 20, rows: int = 4096) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most about `most` bytes."""
    lean()
    for b in batches:
        if b.num_rows:
            step = max(1, min(rows, int(b.num_rows * most / max(1, b.nbytes))))
            for i in range(0, b.num_rows, step):
                yield b.slice(i, step)
    trim()


def uniform(keys: np.ndarray) -> np.ndarray:
    """Mixed 64-bit keys (the finaliser of SplitMix64)."""
    x = keys.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
