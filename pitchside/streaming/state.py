"""Changelogs as streams: the latest state in a table, and windows over events."""

from __future__ import annotations

from collections.abc import Sequence
from pathlib import PurePosixPath

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.upsert import apply_changes


class StateTable:
    """A table of versions in a folder: each batch writes the next version whole and then names it, so a batch that is
    repeated after a failure gives the same version again."""

    def __init__(self, spark: SparkSession, path: str, ddl: str):
        self.spark, self.path, self.ddl = spark, path, ddl

    def _fs(self):
        at = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        return at.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _exists(self, version: int) -> bool:
        return self._fs().exists(self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/v{version}/_SUCCESS"))

    def read(self, version: int | None = None) -> DataFrame:
        if version is None:
            version = self.newest()
        if version < 0:
            return self.spark.createDataFrame([], self.ddl)
        return self.spark.read.schema(self.ddl).parquet(f"{self.path}/v{version}")

    def newest(self) -> int:
        fs, at = self._fs(), self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        if not fs.exists(at):
            return -1
        names = [PurePosixPath(x.getPath().toString()).name for x in fs.listStatus(at)]
        return max((int(n[1:]) for n in names if n[1:].isdigit() and self._exists(int(n[1:]))), default=-1)

    def write(self, df: DataFrame, version: int) -> None:
        df.write.mode("overwrite").parquet(f"{self.path}/v{version}")


def keep_state(changes: DataFrame, table: StateTable, order: Sequence[str], deleted: Column, keys: Sequence[str], checkpoint: str, strict: bool = True) -> StreamingQuery:
    """A stream of changes into the table: newest wins, deletions remove. Batch n reads version n - 1, so it can be repeated."""

    def batch(rows: DataFrame, n: int) -> None:
        table.write(apply_changes(table.read(n - 1), rows, order, deleted, keys, strict), n)

    return changes.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def tumbling_counts(events: DataFrame, ts: str, by: Sequence[str], width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    rows = events.withWatermark(ts, late) if events.isStreaming else events
    return rows.groupBy(F.window(ts, width).alias("w"), *by).agg(F.count("*").alias("events")).select(F.col("w.start").alias("window_start"), *by, "events")


def session_counts(events: DataFrame, ts: str, by: Sequence[str], gap: str = "30 minutes", late: str = "10 minutes") -> DataFrame:
    rows = events.withWatermark(ts, late) if events.isStreaming else events
    return rows.groupBy(F.session_window(ts, gap).alias("w"), *by).agg(F.count("*").alias("events")).select(*by, F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "events")


def latest_of_changelog(changes: DataFrame, keys: Sequence[str], order: Sequence[str], deleted: Column) -> DataFrame:
    """The state that a whole changelog leaves: of each key the last change, if it is no deletion."""
    rows = changes.withColumn("_gone", deleted)
    newest = F.max_by(F.struct(*(c for c in rows.columns if c not in keys)), F.struct(*order))
    out = rows.groupBy(*keys).agg(newest.alias("_r")).where(~F.coalesce("_r._gone", F.lit(False)))
    return out.select(*(F.col(c) if c in keys else F.col(f"_r.{c}").alias(c) for c in changes.columns))
