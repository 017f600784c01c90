"""Tables from files: saved states, lists in CSV, and probes of addresses."""

from __future__ import annotations

import json
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# fixed value: a state file's name is its feed, a stamp, and maybe counts
STAMP = r"([^/]+?)[-_](\d{4}-?\d{2}-?\d{2})(?:[T_-]?(\d{2}:?\d{2}(?::?\d{2})?))?[^/]*$"


def saved_states(spark: SparkSession, path: str) -> DataFrame:
    """Items of saved feed states, JSON objects {"items": {id: item}, "next_url", "status"}, also gzipped, with the feed and
    day that the file's name says. Pickled states are not read: loading them would run what they say."""
    rows = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), F.try_parse_json("value").alias("v"))
    items = F.explode(F.from_json(F.to_json(F.try_variant_get("v", "$.items", "variant")), "map<string,string>")).alias("id", "item")
    return rows.select(*file_stamp(F.col("file")), F.try_variant_get("v", "$.status", "string").alias("status"), F.try_variant_get("v", "$.next_url", "string").alias("next_url"), items)


def file_stamp(name: Column) -> list[Column]:
    day = F.regexp_replace(F.regexp_extract(name, STAMP, 2), "-", "")
    return [F.regexp_extract(name, STAMP, 1).alias("feed"), F.try_to_timestamp(day, F.lit("yyyyMMdd")).cast("date").alias("day")]


def read_list(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    return spark.read.csv(path, header=True, schema=ddl, mode="PERMISSIVE")


def live_postcodes(postcodes: DataFrame, ended: str = "doterm") -> DataFrame:
    """Postcodes that are in use, with their places."""
    return postcodes.where(F.col(ended).isNull()).select(F.regexp_replace(F.upper("pcds"), r"\s+", " ").alias("postal_code"), F.col("lat").try_cast("double").alias("latitude"), F.col("long").try_cast("double").alias("longitude"))


def with_coordinates(rows: DataFrame, postcodes: DataFrame) -> DataFrame:
    """Rows (postal_code, latitude, longitude) get a postcode's place where they have none."""
    key = lambda c: F.upper(F.regexp_replace(c, r"\s+", ""))
    given = postcodes.select(key(F.col("postal_code")).alias("_pc"), F.col("latitude").alias("_lat"), F.col("longitude").alias("_lng"))
    both = rows.join(given, key(rows["postal_code"]) == F.col("_pc"), "left")
    none = F.col("latitude").isNull() & F.col("longitude").isNull()
    pick = {"latitude": F.when(none, F.col("_lat")).otherwise(F.col("latitude")), "longitude": F.when(none, F.col("_lng")).otherwise(F.col("longitude"))}
    return both.select(*(pick[c].alias(c) if c in pick else F.col(c) for c in rows.columns))


def probe_one(url: str, timeout: float = 20) -> tuple[str, str]:
    """ok, http_error, parse_error or empty, with words for it."""
    try:
        with urllib.request.urlopen(url, timeout=timeout) as r:  # noqa: S310
            body = r.read()
    except urllib.error.HTTPError as e:
        return "http_error", f"HTTP {e.code}"
    except (OSError, ValueError) as e:
        return "http_error", f"Request failed: {type(e).__name__}"
    try:
        items = json.loads(body)["items"]
    except (ValueError, KeyError, TypeError):
        return "parse_error", "Response is not valid JSON with 'items'"
    return ("ok", "") if items else ("empty", "Feed has no items")


def probe(feeds: DataFrame, one: Callable[[str], tuple[str, str]] = probe_one) -> DataFrame:
    """feed_id, probe_kind, probe_message for feeds (feed_id, feed_url), asked side by side."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            said = [one(u) for u in f["feed_url"]]
            yield pd.DataFrame({"feed_id": f["feed_id"], "probe_kind": [x[0] for x in said], "probe_message": [x[1] for x in said]})

    return feeds.select("feed_id", "feed_url").mapInPandas(run, "feed_id string, probe_kind string, probe_message string")
