"""Counts per feed over opportunities and the sub-events that they hold inline."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.payload import object_text, text_at, texts
from ..schemas import timestamp

FEED = ("dataset_url", "feed_id")
# keys may hold an object, a list or a text, so they are read as JSON texts, all in one parse
SUB = "`@type` string, type string, startDate string, dateStart string, activity string, activities string, facilityType string, facilities string, accessibilitySupport string, organizer string, location string"
PAYLOAD = "accessibilitySupport string, organizer string"


def inline(opportunities: DataFrame) -> DataFrame:
    """dataset_url, feed_id, sub (a struct of JSON texts): the sub-events given as objects, not as references."""
    listed = opportunities.where("feed_id is not null").select(*FEED, F.explode(texts(F.col("has_subEvent"))).alias("t"))
    return listed.where(object_text(F.col("t"))).select(*FEED, F.from_json("t", SUB).alias("sub"))


def bare(c: Column) -> Column:
    """A scalar's text; an object or a list is none."""
    return F.when(~c.rlike(r"^[\[{]"), c)


def pref_labels(c: Column) -> Column:
    """prefLabel of an object, or of each object in a list."""
    return F.when(object_text(c), F.array(text_at(c, "$.prefLabel"))).otherwise(F.transform(texts(c), lambda x: text_at(x, "$.prefLabel")))


def window_counts(start: Column, reference: date, days: int = 7) -> list[Column]:
    """Dated, future, and within the days from the reference date (half-open)."""
    ref = F.lit(reference).cast("timestamp")
    soon = (start >= ref) & (start < F.lit(reference).cast("timestamp") + F.expr(f"INTERVAL {days} DAY"))
    return [F.count_if(start.isNotNull()), F.count_if(start >= ref), F.count_if(soon)]


def base_metrics(opportunities: DataFrame, reference: date, days: int = 7) -> DataFrame:
    """A row per feed: items, and dated, future and next week's opportunities with the inline ones."""
    names = ("num_opportunity_items", "num_future_opportunity_items", "num_future_week_opportunity_items")
    root = opportunities.where("feed_id is not null").groupBy(*FEED)
    root = root.agg(F.count("*").alias("num_items"), *(c.alias(n) for c, n in zip(window_counts(F.col("startDate"), reference, days), names, strict=True)))
    start = F.coalesce(bare(F.col("sub.startDate")), bare(F.col("sub.dateStart")))
    own = inline(opportunities).select(*FEED, timestamp(start).alias("start")).groupBy(*FEED)
    own = own.agg(*(c.alias(f"inline_{n}") for c, n in zip(window_counts(F.col("start"), reference, days), names, strict=True)))
    # groups by dataset and feed on both sides share one partitioning, so the join moves nothing again
    both = root.join(own, list(FEED), "left")
    return both.select(*FEED, "num_items", *((F.col(n) + F.coalesce(f"inline_{n}", F.lit(0))).alias(n) for n in names))


def values(opportunities: DataFrame, subs: DataFrame | None = None, only: str | None = None) -> DataFrame:
    """dataset_url, feed_id, category, value, one row per mention, for six categories at once. One pass over the rows
    and one over the inline sub-events; all counts below come from this."""
    rows = opportunities.where("feed_id is not null").withColumn("_own", F.from_json("json_data", PAYLOAD)).withColumn("_old", F.from_json("inherited_data", PAYLOAD))
    access = F.transform(F.coalesce(texts(F.col("_own.accessibilitySupport")), texts(F.col("_old.accessibilitySupport"))), lambda x: text_at(x, "$.prefLabel"))
    name = F.trim(F.coalesce(text_at(F.col("_own.organizer"), "$.name"), text_at(F.col("_old.organizer"), "$.name")))
    root = rows.select(*FEED, _long({"item_kind": F.array("kind"), "item_type": F.array("kind"), "activity": F.col("activity"), "facility": F.col("facility"), "accessibility": access, "organizer": F.array(name)}, only))

    def both(*names: str) -> Column:
        return F.flatten(F.array(*(F.coalesce(pref_labels(F.col(f"sub.{n}")), F.array().cast("array<string>")) for n in names)))

    kinds = F.array(F.coalesce(bare(F.col("sub.@type")), bare(F.col("sub.type"))))
    inner = (inline(opportunities) if subs is None else subs).select(
        *FEED, _long({"item_type": kinds, "activity": both("activity", "activities"), "facility": both("facilityType", "facilities"), "accessibility": both("accessibilitySupport"), "organizer": F.array(F.trim(text_at(F.col("sub.organizer"), "$.name")))}, only)
    )
    out = root.unionByName(inner).select(*FEED, "m.category", "m.value")
    return out.where(F.col("value").isNotNull() & ((F.col("category") != "organizer") | (F.col("value") != "")))


def _long(columns: dict[str, Column], only: str | None) -> Column:
    def tagged(category: str, values: Column) -> Column:
        return F.transform(F.coalesce(values, F.array().cast("array<string>")), lambda x: F.struct(F.lit(category).alias("category"), x.alias("value")))

    picked = [tagged(c, v) for c, v in columns.items() if only in (None, c)]
    return F.explode(F.flatten(F.array(*picked)) if picked else F.array().cast("array<struct<category:string,value:string>>")).alias("m")


def category_counts(opportunities: DataFrame) -> DataFrame:
    """dataset_url, feed_id, category, value, cnt."""
    return values(opportunities).groupBy(*FEED, "category", "value").agg(F.count("*").alias("cnt"))


def counts_of(opportunities: DataFrame, category: str) -> DataFrame:
    return values(opportunities, only=category).groupBy(*FEED, "value").agg(F.count("*").alias("cnt"))


def location_points(opportunities: DataFrame) -> DataFrame:
    """dataset_url, feed_id, lat, lng, cnt: distinct points, before any spatial work."""
    rows = opportunities.where("feed_id is not null and location is not null").withColumn("p", F.from_json("location", "latitude string, longitude string"))
    root = rows.select(*FEED, bare(F.col("p.latitude")).alias("a"), bare(F.col("p.longitude")).alias("b"))
    spot = F.from_json("sub.location", "geo struct<latitude:string,longitude:string>")
    own = inline(opportunities).select(*FEED, spot.alias("p")).select(*FEED, bare(F.col("p.geo.latitude")).alias("a"), bare(F.col("p.geo.longitude")).alias("b"))
    both = root.unionByName(own).where("a is not null and b is not null")
    return both.groupBy(*FEED, F.col("a").try_cast("double").alias("lat"), F.col("b").try_cast("double").alias("lng")).agg(F.count("*").alias("cnt"))


def counts_map(counts: DataFrame, by: tuple[str, ...] = ("feed_id",)) -> DataFrame:
    """A map of value to count per feed; equal values of a feed under several datasets are summed."""
    summed = counts.groupBy(*by, "value").agg(F.sum("cnt").alias("cnt"))
    return summed.groupBy(*by).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("value", "cnt")))).alias("counts"))


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
