"""Ids, addresses, names of feeds, and dates as people write them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values
FEED_TYPES = ("HeadlineEvent", "Event", "OnDemandEvent", "FacilityUse", "IndividualFacilityUse", "Slot", "SessionSeries", "ScheduledSession", "CourseInstance", "")
SUPER_EVENTS = ("SessionSeries", "FacilityUse", "IndividualFacilityUse", "EventSeries", "league")
SUB_EVENTS = (
    "ScheduledSession", "ScheduledSessions", "Session", "Sessions", "session", "sessions", "ScheduledSession.SessionSeries",
    "Slot", "Slot for FacilityUse", "FacilityUse/Slot", "FacilityUse.Slot", "IndividualFacilityUse/Slot", "IndividualFacilityUse.Slot",
    "Event", "event", "HeadlineEvent", "OnDemandEvent", "CourseInstance",
)
DISPLAY_FORMATS = ("yyyy-MM-dd'T'HH:mm:ssXXX", "yyyy-MM-dd'T'HH:mm:ss.SSSXXX", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd'T'HH:mm", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd", "dd/MM/yyyy HH:mm", "dd/MM/yyyy")


def feed_id(url: Column) -> Column:
    bare = F.regexp_replace(F.regexp_replace(url, r"^https?://", ""), r"^www\.", "")
    return F.btrim(F.translate(bare, "./", "--"), F.lit("-"))


def provider(url: Column) -> Column:
    """Host and port without www."""
    return F.regexp_replace(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1), r"^www\.", "")


def spec_url(url: Column) -> Column:
    """One form of equivalent addresses: https, host in lower case without www, path with slashes around."""
    host = F.regexp_replace(F.lower(provider(F.trim(url))), r"^www\.", "")
    path = F.regexp_extract(F.trim(url), r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    path = F.when(path.startswith("/"), path).otherwise(F.concat(F.lit("/"), path))
    return F.concat(F.lit("https://"), host, F.when(path.endswith("/"), path).otherwise(F.concat(path, F.lit("/"))))


def feed_type(name: Column) -> Column:
    low = F.lower(name)
    return F.when(name.isin(*FEED_TYPES), name).when(low.contains("slot"), "Slot").when(low.contains("scheduled"), "ScheduledSession").when(low.contains("session"), "SessionSeries").otherwise("")


def event_type(label: Column) -> Column:
    return F.when(label.isin(*SUPER_EVENTS), "superevent").when(label.isin(*SUB_EVENTS), "subevent")


def tail(c: Column) -> Column:
    """What follows the last slash."""
    return F.element_at(F.split(c.cast("string"), "/"), -1)


def first_url(url: Column, after_timestamp: Column, after_id: Column, change_number: Column) -> Column:
    """Where to go on reading a feed: a change number goes before a timestamp and id."""
    join = F.when(url.contains("?"), "&").otherwise("?")
    pair = F.concat(url, join, F.lit("afterTimestamp="), after_timestamp.cast("string"), F.lit("&afterId="), after_id.cast("string"))
    return F.when(change_number.isNotNull(), F.concat(url, join, F.lit("afterChangeNumber="), change_number.cast("string"))).when(after_timestamp.isNotNull() & after_id.isNotNull(), pair).otherwise(url)


def cursor(url: Column) -> Column:
    """A struct of the three parts of a place in a feed, null where the address lacks them."""
    part = lambda name: F.nullif(F.regexp_extract(url, rf"[?&]{name}=([^&#]*)", 1), F.lit(""))
    return F.struct(part("afterTimestamp").alias("afterTimestamp"), part("afterId").alias("afterId"), part("afterChangeNumber").try_cast("bigint").alias("afterChangeNumber"))


def display_date(c: Column, out: str = "EEE d MMM yyyy HH:mm") -> Column:
    """The first format that fits, written for people; text that fits none stays."""
    found = F.coalesce(*(F.try_to_timestamp(c, F.lit(f)) for f in DISPLAY_FORMATS))
    return F.coalesce(F.date_format(found, out), c)


def file_kind(payload_kind: Column, filename: Column, tokens: tuple[tuple[str, str], ...]) -> Column:
    """The payload's kind, else the first token that the file's name holds."""
    out = F.lit(None).cast("string")
    for token, name in reversed(tokens):
        out = F.when(F.lower(filename).contains(token), name).otherwise(out)
    return F.coalesce(payload_kind, out)
