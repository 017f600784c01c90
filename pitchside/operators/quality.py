"""Data quality of feeds: completeness, versions, missing properties, status and grade."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import specs
from ..functions import payload as P

COMPLETE = ("location", "start_date", "end_date", "activities", "facilities", "age_range", "level", "accessibility_support", "gender_restriction")
NO_FUTURE_EXEMPT = ("FacilityUse", "SessionSeries")  # fixed value


def completeness(opportunities: DataFrame, reference: date, days: int = 5) -> DataFrame:
    """Percentages of items of the last days that have a value, per feed."""
    filled = lambda c: F.coalesce(F.size(c) > 0, F.lit(False))
    object_ = lambda c: F.col(c).isNotNull() & ~F.trim(c).isin("null", "{}")
    has = {
        "location": object_("location"), "start_date": F.col("startDate").isNotNull(), "end_date": F.col("endDate").isNotNull(),
        "activities": filled("activity"), "facilities": filled("facility"), "age_range": object_("ageRange"),
        "level": F.col("level").isNotNull() & ~F.trim("level").isin("null", '""', "{}", "[]"), "accessibility_support": filled("accessibilitySupport"),
        "gender_restriction": F.col("genderRestriction") != "",
    }
    recent = opportunities.where(F.col("feed_id").isNotNull() & (F.col("last_updated") >= F.date_sub(F.lit(reference), days)))
    return recent.groupBy("dataset_url", "feed_id").agg(F.count("*").alias("total_items"), *((F.count_if(has[k]) / F.count("*") * 100).alias(f"{k}_completeness") for k in COMPLETE))


def with_aliases(keys: Column, category: Column) -> Column:
    """An item's keys and the properties that they stand for."""
    out = [keys]
    for (own, prop), names in specs.ALTERNATIVES.items():
        fits = F.arrays_overlap(keys, F.array(*map(F.lit, names)))
        fits = fits if own is None else fits & (category == own)
        out.append(F.when(fits, F.array(F.lit(prop))).otherwise(F.array().cast("array<string>")))
    return F.array_distinct(F.concat(*out))


def version_scores(items: DataFrame) -> DataFrame:
    """feed columns, category, version, ordinal, score, required_pct, recommended_pct: means over a feed's items. items: dataset_url,
    feed_id, category, keys (the payload's). Scores are sums over properties, so items are first reduced to how many
    of a feed have each property, and the specifications are expressions over those few rows."""
    by = ["dataset_url", "feed_id", "category"]
    totals = items.groupBy(*by).agg(F.count("*").alias("n"))
    props = items.select(*by, F.explode(with_aliases(F.col("keys"), F.col("category"))).alias("prop")).groupBy(*by, "prop").agg(F.count("*").alias("hits"))
    seen = props.groupBy(*by).agg(F.map_from_entries(F.collect_list(F.struct("prop", "hits"))).alias("seen"))
    feeds = totals.join(seen, by, "left").withColumn("seen", F.coalesce("seen", F.create_map().cast("map<string,bigint>")))
    structs = []
    for category in specs.SPECS:
        for k, version in enumerate(specs.versions(category)):
            own = specs.properties(category, version)
            share = {p: F.coalesce(F.try_element_at("seen", F.lit(p)), F.lit(0)) / F.col("n") for p in own}
            score = sum((share[p] * (specs.WEIGHTS[s][0] - specs.WEIGHTS[s][1]) + specs.WEIGHTS[s][1] for p, s in own.items()), F.lit(0.0))
            parts = {s: sum((share[p] for p in own if own[p] == s), F.lit(0.0)) / max(1, sum(x == s for x in own.values())) * 100 for s in ("required", "recommended")}
            structs.append(F.when(F.col("category") == category, F.struct(F.lit(version).alias("version"), F.lit(k).alias("ordinal"), score.alias("score"), *(parts[s].alias(f"{s}_pct") for s in parts))))
    return feeds.select(*by, F.explode(F.array_compact(F.array(*structs))).alias("s")).select(*by, "s.*")


def item_categories(samples: DataFrame) -> DataFrame:
    """dataset_url, feed_id, feed_type, category, keys of sampled items (json_data, feed_type). The feed's type says the
    category; where that is Event, the most common type of the items may say another (the first of equals)."""
    types = F.from_json("json_data", "`@type` string, type string")
    first = lambda c: F.nullif(F.when(c.startswith("["), F.get(P.texts(c), F.lit(0))).otherwise(c), F.lit(""))
    rows = samples.withColumn("_t", types).select("dataset_url", "feed_id", "feed_type", "seq", F.coalesce(first(F.col("_t.@type")), first(F.col("_t.type")), F.lit("")).alias("kind"), F.filter(F.json_object_keys("json_data"), lambda k: k != "@context").alias("keys"))
    rows = rows.where("keys is not null")
    per_kind = rows.groupBy("dataset_url", "feed_id", "kind").agg(F.count("*").alias("n"), F.min("seq").alias("first"))
    common = per_kind.groupBy("dataset_url", "feed_id").agg(F.max_by("kind", F.struct("n", (-F.col("first")).alias("f"))).alias("common"))
    category = lambda c: F.coalesce(F.create_map(*(F.lit(x) for kv in specs.CATEGORY_OF.items() for x in kv))[F.trim(c)], F.lit("Event"))
    own = category(F.coalesce("feed_type", F.lit("")))
    out = rows.join(common, ["dataset_url", "feed_id"])
    return out.select("dataset_url", "feed_id", "feed_type", F.when(own == "Event", category(F.col("common"))).otherwise(own).alias("category"), "keys")


def detect_versions(items: DataFrame, scores: DataFrame, least_required: float = 50.0) -> DataFrame:
    """dataset_url, feed_id, category, version, score (0 to 100, one decimal), required_pct, recommended_pct. The best mean wins, the
    earlier of equals; properties that only later versions have overrule it for events."""
    any_of = lambda names: F.max(F.arrays_overlap("keys", F.array(*map(F.lit, names))))
    flags = items.groupBy("dataset_url", "feed_id").agg(any_of(specs.V2_ONLY).alias("v2"), any_of(specs.V21_ONLY).alias("v21"))
    best = lambda which: F.max_by("version", F.when(which, F.struct("score", (-F.col("ordinal")).alias("o"))))
    picked = scores.groupBy("dataset_url", "feed_id", "category").agg(best(F.lit(True)).alias("best"), best(F.col("version").startswith("V2")).alias("best2"), F.map_from_entries(F.collect_list(F.struct("version", F.struct("score", "required_pct", "recommended_pct")))).alias("all"))
    event = F.col("category") == "Event"
    chosen = F.when(event & F.col("v21"), "V2.1").when(event & F.col("v2") & F.col("best").startswith("V1"), F.col("best2")).otherwise(F.col("best"))
    chosen = F.when(event & (chosen == "V1.0"), "V1.1").otherwise(chosen)
    out = picked.join(flags, ["dataset_url", "feed_id"]).withColumn("v", chosen)
    own = F.col("all")[F.col("v")]
    low = event & F.col("v").startswith("V1") & (own["required_pct"] < least_required)
    span = F.lit(None).cast("double")
    for category in specs.SPECS:
        for version in specs.versions(category):
            least, most = specs.bounds(category, version)
            span = F.when((F.col("category") == category) & (F.col("v") == version), (own["score"] - least) / (most - least) * 100).otherwise(span)
    score = F.when(~low, F.round(F.greatest(F.lit(0.0), F.least(F.lit(100.0), span)), 1))
    return out.select("dataset_url", "feed_id", "category", F.when(low, "V0.x").otherwise(F.col("v")).alias("version"), score.alias("score"), F.round(own["required_pct"], 1).alias("required_pct"), F.round(own["recommended_pct"], 1).alias("recommended_pct"))


def missing_required(samples: DataFrame) -> DataFrame:
    """dataset_url, feed_id, kind, missing: properties that no sampled payload of the kind has a value for."""
    names = sorted({p for own in specs.REQUIRED_BY_KIND.values() for p in own})
    # texts of all wanted properties from one parse; JSON null and absent ones are null
    read = samples.where("kind is not null").withColumn("_p", F.from_json("json_data", ", ".join(f"`{n}` string" for n in [*names, "type"])))

    def given(name: str) -> Column:
        own = F.col("_p")[name]
        has = own.isNotNull() & ~own.isin("", "[]", "{}")
        return has | given("type") if name == "@type" else has

    rows = read.select("dataset_url", "feed_id", F.trim("kind").alias("kind"), *(F.coalesce(given(p), F.lit(False)).alias(p) for p in names))
    has = rows.groupBy("dataset_url", "feed_id", "kind").agg(*(F.bool_or(f"`{p}`").alias(p) for p in names))
    out = F.lit(None).cast("array<string>")
    for kind, own in specs.REQUIRED_BY_KIND.items():
        out = F.when(F.col("kind") == kind, F.array_compact(F.array(*(F.when(~F.col(f"`{p}`"), F.lit(p)) for p in own)))).otherwise(out)
    return has.select("dataset_url", "feed_id", "kind", out.alias("missing")).where(F.size("missing") > 0)


def missing_text(missing: DataFrame) -> DataFrame:
    """dataset_url, feed_id, missing_text: kinds in order with their properties."""
    own = missing.groupBy("dataset_url", "feed_id").agg(F.array_sort(F.collect_list(F.struct("kind", F.array_join("missing", ", ").alias("m")))).alias("l"))
    return own.select("dataset_url", "feed_id", F.array_join(F.transform("l", lambda x: F.concat(x["kind"], F.lit(": "), x["m"])), "; ").alias("missing_text"))


def classify(rows: DataFrame) -> DataFrame:
    """`rows` (ingestion_status, probe_kind, probe_message, missing_text, num_future, feed_type) with status, warnings, errors."""
    ingestion = F.coalesce("ingestion_status", F.lit(""))
    probe = F.coalesce("probe_kind", F.lit(""))
    failed, nothing = probe.isin("http_error", "parse_error"), probe == "empty"
    broken = ingestion == "ERROR"
    idle = (F.col("num_future") == 0) & ~F.coalesce("feed_type", F.lit("")).isin(*NO_FUTURE_EXEMPT)
    warned = ingestion == "WARNING"
    errors = F.when(broken, F.array(F.when(failed | nothing, F.col("probe_message")).otherwise("Data parsing error (invalid JSON or missing 'items')"))).otherwise(
        F.array_distinct(F.array_compact(F.array(F.when(warned & failed, F.col("probe_message")), F.when(idle & failed, F.col("probe_message")))))
    )
    warnings = F.when(~broken, F.array_distinct(F.array_compact(F.array(
        F.when(F.col("missing_text").isNotNull(), F.concat(F.lit("Missing required fields — "), F.col("missing_text"))),
        F.when((warned | idle) & nothing, F.col("probe_message")),
        F.when(idle & ~nothing & ~failed, F.lit("No future opportunities scheduled")),
    )))).otherwise(F.array().cast("array<string>"))
    out = rows.withColumn("errors", errors).withColumn("warnings", warnings)
    return out.withColumn("status", F.when(F.size("errors") > 0, "ERROR").when(F.size("warnings") > 0, "WARNING").otherwise("OK"))


def grade(status: Column, num_future: Column, location: Column, start: Column, activities: Column, facilities: Column, any_missing: Column) -> Column:
    loc, begin, acts, facs = (F.coalesce(c, F.lit(0.0)) for c in (location, start, activities, facilities))
    gold = (num_future > 150) & (loc >= 40) & (begin >= 40) & ((acts >= 5) | (facs >= 5)) & ~any_missing
    silver = (loc >= 25) & (begin >= 15) & ~any_missing
    return F.when((num_future != 0) & ~status.isin("WARNING", "ERROR"), F.when(gold, "Gold").when(silver, "Silver").otherwise("Bronze"))


def feed_quality(feeds: DataFrame, metrics: DataFrame, complete: DataFrame, status: DataFrame, missing: DataFrame, versions: DataFrame, probes: DataFrame) -> DataFrame:
    """A row per feed with status, messages, completeness, grade and version."""
    keys = ["dataset_url", "feed_id"]
    future = metrics.groupBy("feed_id").agg(F.sum("num_future_opportunity_items").alias("num_future"))
    rows = feeds.join(future, "feed_id", "left").join(status.withColumnRenamed("status", "ingestion_status"), "feed_id", "left").join(probes, "feed_id", "left")
    rows = rows.join(missing_text(missing), keys, "left").join(complete, keys, "left").join(versions.select(*keys, F.col("version").alias("feed_version"), "score"), keys, "left")
    rows = classify(rows.withColumn("num_future", F.coalesce("num_future", F.lit(0))))
    percent = [F.round(f"{k}_completeness", 2).alias(f"{k}_completeness") for k in COMPLETE]
    graded = grade(F.col("status"), F.col("num_future"), *(F.col(f"{k}_completeness") for k in ("location", "start_date", "activities", "facilities")), F.col("missing_text").isNotNull())
    return rows.select(*keys, "feed_type", "is_regular", "status", "warnings", "errors", "missing_text", *percent, F.col("num_future").alias("num_future_opportunity_items"), graded.alias("grade"), F.coalesce("feed_version", F.lit("Unknown")).alias("feed_version"), "score")
