"""Figures as dashboards show them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BINS = ("Very low", "Low", "Medium", "High", "Very high")


def top(counts: DataFrame, n: int = 20, value: str = "value", count: str = "count") -> DataFrame:
    return counts.orderBy(F.col(count).desc(), F.col(value)).limit(n)


def quantile_bins(areas: DataFrame, count: str = "count", labels: tuple[str, ...] = BINS) -> DataFrame:
    """Each area's bin between equal quantiles of the counts; no count, no bin. The quantiles are exact and a row of their own."""
    cuts = areas.agg(F.percentile(count, F.array(*(F.lit(k / len(labels)) for k in range(1, len(labels))))).alias("_cuts"))
    out = F.when(F.col(count).isNull(), F.lit(None).cast("string"))
    for k, name in enumerate(labels[:-1]):
        out = out.when(F.col(count) <= F.get("_cuts", F.lit(k)), name)
    return areas.crossJoin(F.broadcast(cuts)).withColumn("bin", out.otherwise(labels[-1])).drop("_cuts")


def coverage(areas: DataFrame, least: int, count: str = "count") -> DataFrame:
    """Share of areas with at least so many; once as the shown figure, which takes areas without a count for covered, and once strictly."""
    shown = F.count_if(F.coalesce(F.col(count) >= least, F.lit(True)))
    strict = F.count_if(F.col(count) >= least)
    return areas.agg(F.count("*").alias("areas"), (shown / F.count("*") * 100).alias("shown_percent"), (strict / F.count("*") * 100).alias("covered_percent"))


def feed_type_counts(feeds: DataFrame, aliases: dict[str, str], missing: str = "Event") -> DataFrame:
    name = F.coalesce(F.nullif(F.trim("type"), F.lit("")), F.lit(missing))
    out = name
    for old, new in aliases.items():
        out = F.when(name == old, new).otherwise(out)
    return feeds.groupBy(out.alias("type")).agg(F.count("*").alias("count"), F.count_distinct("logo_url").alias("logos"))


def search(rows: DataFrame, text: str, *columns: str) -> DataFrame:
    """Rows with the text in any of the columns, in any case; it is no pattern."""
    hit = F.lit(False)
    for c in columns:
        hit = hit | F.coalesce(F.contains(F.lower(c), F.lit(text.lower())), F.lit(False))
    return rows.where(hit)


def card(v: Column, paths: dict[str, str]) -> list[Column]:
    from ..functions.payload import scalar

    return [scalar(v, p).alias(name) for name, p in paths.items()]
