"""Feeds from dataset pages: linked data in scripts, links, and catalogues of catalogues."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import payload as P
from ..functions import text as X
from ..operators.upsert import keep_last

SCRIPT = r"(?is)<script[^>]*type\s*=\s*[\"']?application/ld\+json[\"']?[^>]*>(.*?)</script>"
HREF = r"(?is)<a\b[^>]*?\bhref\s*=\s*[\"']?([^\"'\s>]+)"


def linked_data(html: Column) -> Column:
    """The page's JSON-LD texts."""
    return F.regexp_extract_all(html, F.lit(SCRIPT), 1)


def links(html: Column) -> Column:
    return F.regexp_extract_all(html, F.lit(HREF), 1)


def feeds_of(pages: DataFrame, access: Column | None = None) -> DataFrame:
    """Feed rows from pages (url, html): one per distribution of the page's dataset."""
    v = P.variant(F.col("_ld"))
    sets = pages.select(F.col("url").alias("dataset_url"), F.explode(linked_data(F.col("html"))).alias("_ld")).select("dataset_url", v.alias("d"))
    rows = sets.select("dataset_url", "d", F.explode(P.listed(F.col("d"), "$.distribution")).alias("f")).where(P.is_object(F.col("f")))
    d, f = F.col("d"), F.col("f")
    url = P.scalar(f, "$.contentUrl")
    out = rows.select(
        X.feed_id(url).alias("id"), url.alias("url"), X.feed_type(F.coalesce(P.scalar(f, "$.name"), F.lit(""))).alias("type"), P.scalar(d, "$.name").alias("dataset_name"),
        "dataset_url", X.provider(F.col("dataset_url")).alias("provider"), P.scalar(d, "$.license").alias("license_url"), P.scalar(d, "$.publisher.logo.url").alias("logo_url"),
        P.scalar(d, "$.publisher.name").alias("publisher_name"), (access if access is not None else F.current_date()).alias("last_access"),
    )
    return keep_last(out.where("url is not null"), ["id"], ["dataset_url", "url"])


def spec_links(html: Column, pattern: str, marker: str = "published using") -> Column:
    """The first link of a page that fits, in one form; links of the element that holds the marker come first."""
    block = F.regexp_extract(html, rf"(?is)<(p|div|span)\b[^>]*>((?:(?!</\1>).)*{marker}.*?)</\1>", 2)
    both = F.concat(links(block), links(html))
    hit = F.get(F.filter(both, lambda x: x.rlike(pattern)), F.lit(0))
    return X.spec_url(hit)


def walk_catalogues(collections: DataFrame, catalogues: DataFrame, datasets: Sequence[str] = ()) -> DataFrame:
    """dataset_url, catalogue_url: collections (payload) name catalogues in hasPart, catalogues (url, payload) name datasets in
    dataset; a dataset in several is that of the last."""
    v = lambda c: P.variant(F.col(c))
    one = lambda x: F.coalesce(F.when(P.is_object(x), P.data_id(x)), P.scalar(x))
    named = collections.select(F.posexplode(P.listed(v("payload"), "$.hasPart")).alias("ord", "c")).select("ord", one(F.col("c")).alias("url"))
    rows = named.join(catalogues, "url").select("ord", F.col("url").alias("catalogue_url"), F.explode(P.listed(v("payload"), "$.dataset")).alias("d"))
    found = rows.select("ord", "catalogue_url", one(F.col("d")).alias("dataset_url")).where("dataset_url is not null")
    out = found.groupBy("dataset_url").agg(F.max_by("catalogue_url", F.struct("ord", "catalogue_url")).alias("catalogue_url"))
    return out.where(F.col("dataset_url").isin(*datasets)) if datasets else out
