"""Latest rows and samples per group. A rank filter of this kind is planned as a group limit before the shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .upsert import keep_last

CURSOR = ("ingestion_date", "afterChangeNumber", "afterTimestamp", "afterId")


def latest_cursor(log: DataFrame, feeds: DataFrame | None = None) -> DataFrame:
    """Where each feed was left; with `feeds`, those never read come with nulls. Timestamps and ids of cursors are texts."""
    last = keep_last(log, ["feed_id"], CURSOR).select("feed_id", "afterTimestamp", "afterId", "afterChangeNumber")
    return last if feeds is None else feeds.select("feed_id").distinct().join(last, "feed_id", "left")


def latest_status(log: DataFrame, order: Sequence[str] = ("ingestion_date",)) -> DataFrame:
    return keep_last(log.where("feed_id is not null"), ["feed_id"], order).select("feed_id", "status")


def feeds_metadata(feeds: DataFrame) -> DataFrame:
    """The latest row of each feed."""
    rest = [c for c in feeds.columns if c not in ("id", "last_access")]
    return keep_last(feeds, ["id"], ["last_access", *rest])


def feeds_per_dataset(feeds: DataFrame) -> DataFrame:
    """Publisher and provider of each dataset, from its latest feed row; of equal dates that of the greatest id."""
    return keep_last(feeds, ["dataset_url"], ["last_access", "id"]).select("dataset_url", "publisher_name", "provider")


def sample(df: DataFrame, by: Sequence[str], n: int, order: Sequence[Column | str] | None = None, seed: int = 42, key: str = "id", randomize: bool = False) -> DataFrame:
    """At most n rows of each group: the first by `order`, else by a hash of the key, which differs by seed."""
    if order is None:
        order = [F.rand()] if randomize else [F.xxhash64(F.lit(seed), key), F.col(key)]
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")


def active_feeds(log: DataFrame, reference: Column, days: int = 30) -> DataFrame:
    """Feeds with a change in the days before the reference date."""
    recent = F.col("ingestion_date") >= F.date_sub(reference, days).cast("timestamp")
    return log.where(F.col("feed_id").isNotNull() & recent & ((F.coalesce("updated", F.lit(0)) > 0) | (F.coalesce("deleted", F.lit(0)) > 0))).select("feed_id").distinct()


def without_stale(feeds: DataFrame, active: DataFrame) -> DataFrame:
    """Feeds that are active, or whose dataset has no active feed, or that have no dataset."""
    both = feeds.join(active.select("feed_id").distinct().withColumn("_active", F.lit(1)), "feed_id", "left")
    any_active = F.max(F.coalesce("_active", F.lit(0))).over(Window.partitionBy("dataset_url"))
    kept = both.withColumn("_any", any_active).where((F.col("_active") == 1) | (F.col("_any") == 0) | F.col("dataset_url").isNull())
    return kept.select(*feeds.columns)


def latest_day(feeds: DataFrame) -> DataFrame:
    """The feeds of the latest day of access."""
    newest = feeds.agg(F.max(F.to_date("last_access")).alias("_day"))
    return feeds.join(F.broadcast(newest), F.to_date("last_access") == F.col("_day"), "left_semi")


def latest_ingestion(log: DataFrame, today: Column | None = None) -> DataFrame:
    """One row: the day of the last ingestion, or today."""
    return log.agg(F.coalesce(F.max(F.to_date("ingestion_date")), today if today is not None else F.current_date()).alias("ingestion_date"))


def ingestion_log(runs: DataFrame) -> DataFrame:
    """Log rows: what was persisted moves the cursor on; what failed keeps the old one and is an ERROR. runs: feed_id,
    ingestion_date, persisted, updated, deleted, status, and next_* and previous_* of the cursor."""
    done = F.coalesce("persisted", F.lit(False))
    cursor = [F.when(done, F.col(f"next_{c}")).otherwise(F.col(f"previous_{c}")).alias(c) for c in CURSOR[1:]]
    counts = [F.when(done, F.col(c)).otherwise(0).cast("bigint").alias(c) for c in ("updated", "deleted")]
    return runs.select("feed_id", "ingestion_date", *counts, *cursor, F.when(done, F.col("status")).otherwise("ERROR").alias("status"))
