"""Which properties publishers use: a walk over payloads, tallies, and reports against a model."""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .sad import with_shares

DEPTH = 6
LEFT_OUT = ("@context", "@type", "type")
NESTED = "array<struct<type:string,fields:array<string>>>"


def entities(payload: object, kind: str | None, depth: int = 0) -> Iterator[tuple[str, list[str]]]:
    """Each typed object in a payload with its keys; the outermost may take its type from `kind`."""
    if depth > DEPTH or not isinstance(payload, dict):
        return
    name = None
    for key in ("@type", "type"):
        given = payload.get(key)
        given = given[0] if isinstance(given, list) and given else given
        if isinstance(given, str) and given.strip():
            name = given.strip()
            break
    if name or kind:
        yield name or kind, [k for k in payload if k not in LEFT_OUT]
    for inner in payload.values():
        for one in inner if isinstance(inner, list) else [inner]:
            yield from entities(one, None, depth + 1)


def walk(rows: DataFrame) -> DataFrame:
    """dataset_url, type, fields: a row per entity in json_data (kind names the outermost)."""

    @F.pandas_udf(NESTED)
    def found(texts: pd.Series, kinds: pd.Series) -> pd.Series:
        def one(text: str | None, kind: str | None) -> list[dict]:
            try:
                payload = json.loads(text) if text else None
            except ValueError:
                payload = None
            return [{"type": t, "fields": f} for t, f in entities(payload, kind)]

        return pd.Series([one(t, k) for t, k in zip(texts, kinds, strict=True)])

    return rows.select("dataset_url", F.explode(found("json_data", "kind")).alias("e")).select("dataset_url", "e.type", "e.fields")


def tallies(walked: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """type, field, instances_with, total_instances, over everything or per dataset."""
    totals = walked.groupBy(*by, "type").agg(F.count("*").alias("total_instances"))
    fields = walked.select(*by, "type", F.explode(F.array_distinct("fields")).alias("field")).groupBy(*by, "type", "field").agg(F.count("*").alias("instances_with"))
    return totals.join(fields, [*by, "type"], "left")


def usage_class(count: Column, percent: Column, rare: float = 1.0, low: float = 10.0) -> Column:
    return F.when(count == 0, "UNUSED").when(percent < rare, "RARE").when(percent < low, "LOW").otherwise("COMMON")


def presence(count: Column, total: Column) -> Column:
    return F.coalesce(F.try_divide(count, total), F.lit(0.0)) * 100


def model_usage(walked: DataFrame, model: DataFrame, category_of: Mapping[str, str], alternatives: Mapping[tuple[str, str], tuple[str, ...]], rare: float = 1.0, low: float = 10.0) -> DataFrame:
    """category, field, model_status, instances_with, total_instances, presence_pct, classification for each field of the
    model, used or not. model: category, field, model_status."""
    own = categorised(walked, category_of)
    also = F.lit(None).cast("array<string>")
    for (category, field), names in alternatives.items():
        also = F.when((F.col("category") == category) & (F.col("field") == field), F.array(*map(F.lit, names))).otherwise(also)
    fields = model.withColumn("names", F.concat(F.array("field"), F.coalesce(also, F.array().cast("array<string>"))))
    totals = own.groupBy("category").agg(F.count("*").alias("total_instances"))
    keys = own.withColumn("eid", F.monotonically_increasing_id()).select("category", "eid", F.explode(F.array_distinct("fields")).alias("name"))
    hits = keys.join(fields.select("category", "field", F.explode("names").alias("name")), ["category", "name"]).groupBy("category", "field").agg(F.count_distinct("eid").alias("instances_with"))
    rows = model.join(totals, "category", "left").join(hits, ["category", "field"], "left").fillna(0, ["total_instances", "instances_with"])
    return _classed(rows, rare, low)


def _classed(rows: DataFrame, rare: float, low: float) -> DataFrame:
    percent = presence(F.col("instances_with"), F.col("total_instances"))
    return rows.withColumn("presence_pct", percent).withColumn("classification", usage_class(F.col("instances_with"), F.col("presence_pct"), rare, low))


def categorised(walked: DataFrame, category_of: Mapping[str, str]) -> DataFrame:
    names = F.create_map(*(F.lit(x) for kv in category_of.items() for x in kv))
    return walked.withColumn("category", names[F.col("type")]).where("category is not null")


def extensions(walked: DataFrame, model: DataFrame, category_of: Mapping[str, str], alternatives: Mapping[tuple[str, str], tuple[str, ...]], rare: float = 1.0, low: float = 10.0) -> DataFrame:
    """Fields of model types that neither the model nor its alternatives have."""
    own = categorised(walked, category_of)
    totals = own.groupBy("category").agg(F.count("*").alias("total_instances"))
    counted = own.select("category", F.explode(F.array_distinct("fields")).alias("field")).groupBy("category", "field").agg(F.count("*").alias("instances_with"))
    known = model.select("category", "field")
    if alternatives:
        known = known.unionByName(model.sparkSession.createDataFrame([(c, n) for (c, _), own in alternatives.items() for n in own], "category string, field string"))
    rest = counted.join(known, ["category", "field"], "left_anti").join(totals, "category")
    return _classed(rest, rare, low)


def discovered(walked: DataFrame, category_of: Mapping[str, str], rare: float = 1.0, low: float = 10.0) -> DataFrame:
    """Types that are not in the model, with their fields."""
    return _classed(tallies(walked.where(~F.col("type").isin(*category_of))).fillna(0, ["instances_with"]), rare, low)


def absent_fields(walked: DataFrame, model: DataFrame, category_of: Mapping[str, str]) -> DataFrame:
    """Per dataset and model type, the model's fields that no instance has."""
    own = categorised(walked, category_of).groupBy("dataset_url", "type", "category").agg(F.array_distinct(F.flatten(F.collect_set("fields"))).alias("seen"))
    fields = model.groupBy("category").agg(F.array_sort(F.collect_list("field")).alias("all"))
    return own.join(fields, "category").select("dataset_url", "type", F.array_except("all", "seen").alias("absent"))


def exact_presence(opportunities: DataFrame, fields: Mapping[str, tuple[str, ...]]) -> DataFrame:
    """kind, field, instances_with, total_instances over all rows, for the fields of each kind. A key with a null counts."""
    names = sorted({f for own in fields.values() for f in own})
    keys = F.json_object_keys("json_data")
    rows = opportunities.where(F.col("kind").isin(*fields)).select("kind", F.coalesce(keys, F.array().cast("array<string>")).alias("keys"))
    wide = rows.groupBy("kind").agg(F.count("*").alias("total_instances"), *(F.count_if(F.array_contains("keys", f)).alias(f) for f in names))
    pairs = F.array(*(F.struct(F.lit(f).alias("field"), F.col(f"`{f}`").alias("instances_with")) for f in names))
    wanted = F.lit(False)
    for kind, own in fields.items():
        wanted = wanted | ((F.col("kind") == kind) & F.col("field").isin(*own))
    return wide.select("kind", "total_instances", F.inline(pairs)).where(wanted)


def dataset_reports(walked: DataFrame, model: DataFrame, category_of: Mapping[str, str], publishers: DataFrame) -> DataFrame:
    """dataset_url, publisher_name, type, instances, present (fields with percentages, most used first), absent."""
    per = tallies(walked, ("dataset_url",)).where("field is not null")
    listed = per.withColumn("pct", presence(F.col("instances_with"), F.col("total_instances")))
    order = F.array_sort(F.collect_list(F.struct((-F.col("pct")).alias("o"), "field", "pct")))
    out = listed.groupBy("dataset_url", "type").agg(F.max("total_instances").alias("instances"), F.transform(order, lambda x: F.struct(x["field"].alias("field"), x["pct"].alias("pct"))).alias("present"))
    named = publishers.groupBy("dataset_url").agg(F.max("publisher_name").alias("publisher_name"))
    return out.join(absent_fields(walked, model, category_of), ["dataset_url", "type"], "left").join(named, "dataset_url", "left")


def markdown(usage: DataFrame, title: str = "Field usage") -> str:
    """A report of the model's fields; the rows are those of the model, few."""
    rows = usage.orderBy("category", "presence_pct", "field").collect()
    lines, now = [f"# {title}", ""], None
    for r in rows:
        if r["category"] != now:
            now = r["category"]
            lines += ["", f"## {now} ({r['total_instances']:,} instances)", "", "| field | status | with | % | class |", "|-|-|-|-|-|"]
        lines.append(f"| {r['field']} | {r['model_status']} | {r['instances_with']:,} | {r['presence_pct']:.1f} | {r['classification']} |")
    return "\n".join(lines) + "\n"


def shares(totals: DataFrame, count: str = "count") -> DataFrame:
    """Each count's percentage of all; the sum is one row that goes to all tasks."""
    return with_shares(totals, {"percentage": count})
