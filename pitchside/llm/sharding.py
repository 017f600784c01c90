"""Sharding by jump consistent hashing: a stable key and the number of shards give the shard, without a ring table.

When shards are appended, a key stays or moves to a new shard. Slots number a shard's rows without gaps: rows that are
equal in what is given are counted and are one row with a number until the end, the rows of a shard fall into buckets by their key, each bucket is numbered
for itself by running sums, and the sums of the buckets before it are added. So no task sees a whole shard, and no key is many rows.

Defined cases: a null text has 0 bytes, size 1 and the crc32 of nothing; a null doc_id is a key like any other;
repeated rows get the same shard and slots of their own; an empty table gives no rows; `assign` reads no other columns, and `with_shards` replaces
columns named `shard` and `grown_shard`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .mixing import times
from .shared import materialise

STEP = 2862933555777941757  # fixed value: the generator that jump consistent hashing is defined by


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each unsigned 64-bit key."""
    key, at = keys.astype(np.uint64), np.zeros(len(keys), np.int64)
    live = np.arange(len(keys))
    while len(live):
        key[live] = key[live] * np.uint64(STEP) + np.uint64(1)
        ahead = ((at[live] + 1) * (2.0**31 / ((key[live] >> np.uint64(33)).astype(np.float64) + 1.0))).astype(np.int64)
        inside = ahead < shards
        live = live[inside]
        at[live] = ahead[inside]
    return at


def with_shards(rows: DataFrame, shards: int, key: str = "key", more: int = 1) -> DataFrame:
    """`rows` with `shard` and `grown_shard`, the shard after `more` shards are appended. `key`: a long."""

    rows = rows.drop("shard", "grown_shard")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = b.column(b.schema.get_field_index(key)).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            both = [pa.array(jump(keys, n).astype(np.int32)) for n in (shards, shards + more)]
            yield pa.RecordBatch.from_arrays([*b.columns, *both], [*b.schema.names, "shard", "grown_shard"])

    return rows.mapInArrow(run, T.StructType([*rows.schema, *(T.StructField(c, T.IntegerType()) for c in ("shard", "grown_shard"))]))


def assign(docs: DataFrame, shards: int = 8, more: int = 1, bucket_rows: int = 50_000) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    rows = docs.select(F.col("doc_id").cast("bigint"), (F.octet_length(text) + 1).cast("bigint").alias("size"), F.crc32(text).alias("text_crc32"))
    rows = rows.groupBy("doc_id", "size", "text_crc32").agg(F.count("*").alias("n")).withColumn("key", F.xxhash64("doc_id"))
    rows = materialise(with_shards(rows, shards, "key", more), "shards")
    buckets = max(1, rows.count() // bucket_rows + 1)
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("key", "size", "text_crc32"), F.lit(buckets)) if buckets > 1 else F.lit(0).cast("bigint"))
    counts = rows.groupBy("shard", "bucket").agg(F.sum("n").alias("many"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("shard", "bucket", F.coalesce(F.sum("many").over(before), F.lit(0)).alias("base"))
    own = Window.partitionBy("shard", "bucket").orderBy("doc_id", "size", "text_crc32").rowsBetween(Window.unboundedPreceding, -1)
    first = rows.withColumn("place", F.coalesce(F.sum("n").over(own), F.lit(0))).join(counts, ["shard", "bucket"])
    slot = (F.col("base") + F.col("place") + F.col("again")).cast("bigint")
    return times(first, F.col("n"), "again").select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", slot.alias("slot"), "grown_shard")


def write_shards(docs: DataFrame, path: str, shards: int = 8) -> None:
    """The documents, in one folder per shard."""
    keyed = with_shards(docs.withColumn("shard_key", F.xxhash64(F.col("doc_id").cast("bigint"))), shards, "shard_key")
    keyed.drop("shard_key", "grown_shard").write.partitionBy("shard").parquet(path)
