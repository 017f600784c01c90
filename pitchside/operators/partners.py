"""Feeds that belong together, items that belong together, and counts over what they make up."""

from __future__ import annotations

import json
from collections.abc import Sequence
from datetime import date

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import event_type, tail

# fixed values: fragments of feed addresses by type, in the order in which they are tried, and the type of each one's partner
FRAGMENTS = {
    "SessionSeries": ("session-series", "sessionseries"),
    "ScheduledSession": ("scheduled-sessions", "scheduledsessions", "scheduled-session", "scheduledsession"),
    "FacilityUse": (
        "individual-facility-uses", "individual-facilityuses", "individualfacility-uses", "individualfacilityuses", "individual-facility-use", "individual-facilityuse",
        "individualfacility-use", "individualfacilityuse", "facility-uses", "facilityuses", "facility-use", "facilityuse",
    ),
    "Slot": (
        "individual-facility-use/slots", "individual-facility-use/slot", "individual-facility-use-slots", "individual-facility-use-slot", "facility-uses/events", "facility-uses/event",
        "facility-uses-events", "facility-uses-event", "facility-use/events", "facility-use/event", "facility-use-events", "facility-use-event", "facility-uses/slots", "facility-uses/slot",
        "facility-uses-slots", "facility-uses-slot", "facility-use/slots", "facility-use/slot", "facility-use-slots", "facility-use-slot", "slots", "slot",
    ),
}
PARTNER = {"SessionSeries": "ScheduledSession", "ScheduledSession": "SessionSeries", "FacilityUse": "Slot", "Slot": "FacilityUse"}


def partner_feeds(feeds: DataFrame, fragments: dict[str, tuple[str, ...]] = FRAGMENTS, partner: dict[str, str] = PARTNER) -> DataFrame:
    """url, partner_url: of the known addresses that a replaced fragment gives, that of the first rule. Rules are an
    array literal, so candidates are made in place and one equi-join tells which exist."""
    rules = [(a, b) for kind, own in fragments.items() for a in own for b in fragments[partner[kind]]]
    tried = F.array(*(F.struct(F.lit(k).alias("rule"), F.lit(a).alias("a"), F.lit(b).alias("b")) for k, (a, b) in enumerate(rules)))
    urls = feeds.select("url").distinct()
    fit = urls.select("url", F.explode(F.filter(tried, lambda r: F.contains(F.col("url"), r["a"]))).alias("r"))
    attempt = fit.select("url", "r.rule", F.replace(F.col("url"), F.col("r.a"), F.col("r.b")).alias("partner_url"))
    known = urls.select(F.col("url").alias("partner_url"))
    return attempt.join(known, "partner_url").groupBy("url").agg(F.min_by("partner_url", "rule").alias("partner_url"))


def paired_once(pairs: DataFrame) -> DataFrame:
    """Each feed in one pair at most: of pairs that share a feed, that of the least address."""
    both = pairs.select(F.least("url", "partner_url").alias("a"), F.greatest("url", "partner_url").alias("b")).where("a != b").distinct()
    rank = lambda c: F.row_number().over(Window.partitionBy(c).orderBy("a", "b"))
    first = both.withColumn("ra", rank("a")).where("ra = 1").withColumn("rb", rank("b")).where("rb = 1")
    return first.join(first.select(F.col("b").alias("a")), "a", "left_anti").select("a", "b")


def get_values(texts: Column, parents: Sequence[str], children: Sequence[str] | None = None, onward: bool = True) -> Column:
    """The values (as JSON texts) that a search of a payload finds: the first key of `parents` in document order, and there, of a pair, a
    key of `children` one layer down. A list gives those of all its elements. Document order is why this reads text."""

    def search(data: object, sought: Sequence[str], inner: Sequence[str] | None, deeper: bool) -> list:
        if isinstance(data, list):
            return [v for x in data for v in search(x, sought, inner, deeper)]
        if isinstance(data, dict):
            for key, value in data.items():
                found: list = []
                if key in sought:
                    if inner is None:
                        found = [value] if value else []
                    elif isinstance(value, (dict, list)):
                        found = search(value, inner, None, False)
                elif deeper and isinstance(value, (dict, list)):
                    found = search(value, sought, inner, deeper)
                if found:
                    return found
        return []

    @F.pandas_udf("array<string>")
    def run(payloads: pd.Series) -> pd.Series:
        def one(text: str | None) -> list[str]:
            try:
                return [json.dumps(v) for v in search(json.loads(text), parents, children, onward)] if text else []
            except ValueError:
                return []

        return payloads.map(one)

    return run(texts)


def partner_items(subs: DataFrame, supers: DataFrame) -> DataFrame:
    """pair, sub_id, super_id: by the tail of the named id, first among item ids, then among data ids, of the pair of feeds that both are in; of several
    supers the last. subs: pair, id, super_ref. supers: pair, id, data_id, seq."""
    last = lambda key: supers.where(F.col(key).isNotNull()).groupBy("pair", tail(F.col(key)).alias("ref")).agg(F.max_by("id", "seq").alias(f"_by_{key}"))
    own = subs.select("pair", F.col("id").alias("sub_id"), tail(F.col("super_ref")).alias("ref"))
    both = own.join(last("id"), ["pair", "ref"], "left").join(last("data_id"), ["pair", "ref"], "left")
    return both.select("pair", "sub_id", F.coalesce("_by_id", "_by_data_id").alias("super_id"))


def feed_event_type(items: DataFrame, feeds: DataFrame) -> DataFrame:
    """feed_id, event_type: what all item types say, else what all kinds say, else the feed's type. A label that says
    nothing is a vote of its own. items: feed_id, type, kind."""
    vote = lambda c: event_type(F.col(c))
    agreed = lambda c: F.when((F.count_distinct(F.coalesce(vote(c), F.lit("?"))) == 1), F.max(vote(c)))
    per = items.groupBy("feed_id").agg(agreed("type").alias("by_type"), agreed("kind").alias("by_kind"))
    return feeds.join(per, "feed_id", "left").select("feed_id", F.coalesce("by_type", "by_kind", event_type(F.col("feed_type"))).alias("event_type"))


def kind_counts(items: DataFrame, column: str) -> DataFrame:
    """Counts by a label; items without one are a group too."""
    return items.groupBy(column).agg(F.count("*").alias("count"))


def item_dates(items: DataFrame, reference: date, days: int = 7) -> DataFrame:
    """`items` with num_dates, num_future, num_week over array column `dates`."""
    ref = F.lit(reference).cast("timestamp")
    end = ref + F.expr(f"INTERVAL {days} DAY")
    count = lambda f: F.size(F.filter("dates", f))
    return items.withColumns({"num_dates": count(lambda d: d.isNotNull()), "num_future": count(lambda d: d >= ref), "num_week": count(lambda d: (d >= ref) & (d < end))})


def own_dates(items: DataFrame) -> DataFrame:
    """`dates` of each item: its inline sub-events' if it has any, else its own start if it is no super-event."""
    own = F.when(~F.coalesce(event_type(F.col("kind")) == "superevent", F.lit(False)) & F.col("startDate").isNotNull(), F.array("startDate")).otherwise(F.array().cast("array<timestamp>"))
    return items.withColumn("dates", F.when(F.size("sub_dates") > 0, F.col("sub_dates")).otherwise(own))


def feed_counters(items: DataFrame, reference: date, days: int = 7) -> DataFrame:
    """Per feed: analysed items, those with dates, and their dates, each also future and next week. Super-events that their
    partners stand for (`represented`) do not count."""
    rows = item_dates(own_dates(items.where(~F.coalesce("represented", F.lit(False)))), reference, days)
    has = lambda c: F.count_if(F.col(c) > 0)
    return rows.groupBy("feed_id").agg(
        F.count("*").alias("num_analysis_items"), has("num_dates").alias("num_opportunity_items"), has("num_future").alias("num_future_items"), has("num_week").alias("num_week_items"),
        F.sum("num_dates").alias("num_start_dates"), F.sum("num_future").alias("num_future_dates"), F.sum("num_week").alias("num_week_dates"),
    )


def presence_vectors(items: DataFrame, value: str) -> DataFrame:
    """Per value: items, and those with dates, future dates, dates next week. items: value column, num_dates, num_future, num_week."""
    return items.where(F.col(value).isNotNull()).groupBy(value).agg(F.count("*").alias("items"), *(F.count_if(F.col(c) > 0).alias(f"with_{c[4:]}") for c in ("num_dates", "num_future", "num_week")))


def cross_tab(rows: DataFrame, first: str, others: Sequence[str]) -> DataFrame:
    """first, dimension, value, count for each of the other columns, in one pass."""
    pairs = F.explode(F.array(*(F.struct(F.lit(c).alias("dimension"), F.col(c).cast("string").alias("value")) for c in others))).alias("p")
    return rows.where(F.col(first).isNotNull()).select(first, pairs).select(first, "p.dimension", "p.value").where("value is not null").groupBy(first, "dimension", "value").agg(F.count("*").alias("count"))


def merge_partners(sub: dict[str, str], sup: dict[str, str]) -> list[Column]:
    """Columns of a pair: scalars of the sub-event before those of the super-event, sets united, kinds joined. sub and sup:
    column by role (kind, scalar, set)."""
    text = lambda c: F.coalesce(F.col(c), F.lit("None"))
    out = [F.concat_ws("_x_", text(sub["kind"]), text(sup["kind"])).alias("kind")]
    out.append(F.coalesce(F.col(sub["scalar"]), F.col(sup["scalar"])).alias("scalar"))
    none = F.array().cast("array<string>")
    out.append(F.array_sort(F.array_union(F.coalesce(F.col(sub["set"]), none), F.coalesce(F.col(sup["set"]), none))).alias("set"))
    return out


def activity_fallback(own: Column, offers: Column, above: Column, facility: Column, unknown: str = "Unknown") -> Column:
    """The first list that holds anything."""
    full = lambda c: F.when(F.size(c) > 0, c)
    return F.coalesce(full(own), full(offers), full(above), full(facility), F.array(F.lit(unknown)))


def facility_lookup(slots: DataFrame, facilities: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Slots with the columns of the facility that they name, by any of its ids; columns that a slot has go first."""
    keys = F.explode(F.array_distinct(F.array_compact(F.array("id", "data_id", "alt_id")))).alias("_key")
    table = facilities.select("seq", keys, *(F.col(c).alias(f"_f_{c}") for c in columns))
    one = table.groupBy("_key").agg(*(F.min_by(F.struct(f"_f_{c}"), "seq").alias(f"_f_{c}") for c in columns))
    both = slots.join(one, F.col("facility_ref") == F.col("_key"), "left")
    return both.select(*(F.coalesce(F.col(c), F.col(f"_f_{c}._f_{c}")).alias(c) if c in columns else F.col(c) for c in slots.columns))


def facility_by_place(slots: DataFrame, facilities: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Slots that name no known facility, with the empty ones of the columns from the first facility at their place with their provider and their activity,
    else with their provider, else with their activity, else at the place alone. Both: lat, lng, provider, activity; facilities: seq."""
    kinds = (("provider", "activity"), ("provider",), ("activity",), ())
    out = slots
    for k, also in enumerate(kinds):
        keys = ["lat", "lng", *also]
        first = facilities.where(" and ".join(f"{c} is not null" for c in keys)).groupBy(*keys).agg(F.min_by(F.struct(*columns), "seq").alias(f"_at_{k}"))
        out = out.join(first, keys, "left")
    pick = lambda c: F.coalesce(F.col(c), F.coalesce(*(F.col(f"_at_{k}") for k in range(len(kinds))))[c]).alias(c)
    return out.select(*(pick(c) if c in columns else F.col(c) for c in slots.columns))


def region_stats(items: DataFrame, no_location: str = "_NO_LOCATION", unmatched: str = "_UNMATCHED") -> DataFrame:
    """Per region: items, organisers and activities. Items without a place and those in no region have rows of their own,
    and come last. items: lat, region, organizer, activities."""
    region = F.when(F.col("lat").isNull(), no_location).otherwise(F.coalesce("region", F.lit(unmatched)))
    rows = items.withColumn("region", region)
    own = rows.groupBy("region").agg(F.count("*").alias("items"), F.count_distinct("organizer").alias("organizers"))
    acts = rows.select("region", F.explode("activities").alias("a")).groupBy("region", "a").agg(F.count("*").alias("n"))
    listed = acts.groupBy("region").agg(F.count("*").alias("activities"), F.map_from_entries(F.array_sort(F.collect_list(F.struct("a", "n")))).alias("activity_counts"))
    return own.join(listed, "region", "left").withColumn("activities", F.coalesce("activities", F.lit(0))).orderBy(F.col("region").startswith("_"), "region")


def age_label(low: Column, high: Column) -> Column:
    """a-b, a+, 0-b or Unknown."""
    return F.when(low.isNotNull() & high.isNotNull(), F.concat_ws("-", low, high)).when(low.isNotNull(), F.concat(low.cast("string"), F.lit("+"))).when(high.isNotNull(), F.concat(F.lit("0-"), high.cast("string"))).otherwise("Unknown")


def history_matrix(seen: DataFrame, runs: Sequence[str]) -> DataFrame:
    """A row per feed address, a column per run, y where it was seen. The runs are given, so nothing is asked for them."""
    return seen.groupBy("feed_url").pivot("run", list(runs)).agg(F.first(F.lit("y"))).fillna("", list(runs))


def scope_figures(feeds: DataFrame) -> DataFrame:
    """One row: publishers, datasets and feeds, all and by scope."""
    named = lambda c, when: F.count_distinct(F.when(when, F.nullif(F.trim(F.col(c).cast("string")), F.lit("")))).alias
    out = []
    for scope, when in (("all", F.lit(True)), ("regular", F.col("is_regular")), ("preview", ~F.col("is_regular"))):
        out += [named("publisher_name", when)(f"publishers_{scope}"), named("dataset_url", when)(f"datasets_{scope}"), F.count_if(when).alias(f"feeds_{scope}")]
    return feeds.agg(*out)
