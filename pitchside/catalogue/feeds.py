"""Counts per feed, scopes, and summaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import counts, insights, sad
from . import mapping as M

Q = M.Registry()
WITH = f"WITH {M.O}, {M.SUB}"
TWO = "dataset_url, feed_id"


def counted(values: str) -> str:
    return f"{WITH} SELECT {TWO}, value, count(*) AS cnt FROM ({values}) WHERE value IS NOT NULL GROUP BY {TWO}, value"


KINDS = f"SELECT {TWO}, kind AS value FROM o"
TYPES = f"SELECT {TWO}, kind AS value FROM o UNION ALL SELECT {TWO}, CASE WHEN i % 2 = 0 THEN 'ScheduledSession' ELSE 'Event' END FROM sub"
ACTIVITIES = f"SELECT {TWO}, p_name AS value FROM o WHERE kind = 'SessionSeries' UNION ALL SELECT {TWO}, p_name FROM sub"
FACILITIES = f"SELECT {TWO}, p_type AS value FROM o WHERE kind <> 'SessionSeries' UNION ALL SELECT {TWO}, p_type FROM sub"
ACCESS = f"SELECT {TWO}, CASE WHEN l_partkey % 4 = 0 THEN p_brand ELSE 'inherited' END AS value FROM o UNION ALL SELECT {TWO}, p_brand FROM sub"
ORGANIZERS = f"SELECT {TWO}, CASE WHEN l_partkey % 5 <> 0 THEN c_name ELSE upper(c_mktsegment) END AS value FROM o UNION ALL SELECT {TWO}, c_name FROM sub"
ALL = " UNION ALL ".join(f"SELECT feed_id, '{c}' AS category, value FROM ({v})" for c, v in (("item_kind", KINDS), ("item_type", TYPES), ("activity", ACTIVITIES), ("facility", FACILITIES), ("accessibility", ACCESS), ("organizer", ORGANIZERS)))
BASE = f"""SELECT {TWO}, count(*) AS num_items,
      count(start_date) + coalesce(max(n), 0) AS num_opportunity_items, count(*) FILTER (start_date >= DATE '1998-06-15') + coalesce(max(f), 0) AS num_future_opportunity_items,
      count(*) FILTER (start_date >= DATE '1998-06-15' AND start_date < DATE '1998-06-22') + coalesce(max(w), 0) AS num_future_week_opportunity_items
    FROM o LEFT JOIN (SELECT {TWO}, count(*) AS n, count(*) FILTER (sub_start >= DATE '1998-06-15') AS f, count(*) FILTER (sub_start >= DATE '1998-06-15' AND sub_start < DATE '1998-06-22') AS w
                      FROM sub GROUP BY {TWO}) AS s USING ({TWO}) GROUP BY {TWO}"""


@Q.add(f"{WITH} {BASE}")
def feed_base_metrics(spark, sf):
    return counts.base_metrics(M.opportunities(spark, sf), M.REF)


for _name, _category, _values in (
    ("feed_kind_counts", "item_kind", KINDS), ("feed_item_type_counts", "item_type", TYPES), ("feed_activity_counts", "activity", ACTIVITIES), ("feed_facility_counts", "facility", FACILITIES),
    ("feed_accessibility_counts", "accessibility", ACCESS), ("feed_organizer_counts", "organizer", ORGANIZERS),
):
    Q.add(counted(_values), _name)(lambda spark, sf, category=_category: counts.counts_of(M.opportunities(spark, sf), category))


@Q.add(f"""{WITH} SELECT {TWO}, round(lat, 4) AS lat, round(lng, 6) AS lng, CAST(sum(c) AS BIGINT) AS cnt FROM (
    SELECT {TWO}, lat, lng, count(*) AS c FROM o WHERE l_partkey % 7 <> 0 GROUP BY ALL UNION ALL SELECT {TWO}, lat, lng, count(*) FROM sub GROUP BY ALL) GROUP BY {TWO}, lat, lng""")
def feed_location_points(spark, sf):
    return counts.location_points(M.opportunities(spark, sf)).select("dataset_url", "feed_id", F.round("lat", 4).alias("lat"), F.round("lng", 6).alias("lng"), "cnt")


@Q.add(f"{WITH} SELECT feed_id, string_agg(value || '=' || cnt, ',' ORDER BY value) AS counts FROM (SELECT feed_id, value, count(*) AS cnt FROM ({TYPES}) GROUP BY ALL) GROUP BY feed_id")
def feed_counts_map(spark, sf):
    maps = counts.counts_map(counts.counts_of(M.opportunities(spark, sf), "item_type"))
    return maps.select("feed_id", F.array_join(F.transform(F.array_sort(F.map_entries("counts")), lambda e: F.concat_ws("=", e["key"], e["value"])), ",").alias("counts"))


SCOPED = f"""scoped AS (SELECT 'all' AS scope, * FROM f UNION ALL SELECT 'regular', * FROM f WHERE is_regular UNION ALL SELECT 'preview', * FROM f WHERE NOT is_regular)"""
ROLL = f"""{WITH}, f AS ({M.FEEDS}), {SCOPED}, c AS (SELECT feed_id, category, value, count(*) AS cnt FROM ({ALL}) WHERE value IS NOT NULL GROUP BY ALL),
    r AS (SELECT scope, category, value, CAST(sum(cnt) AS BIGINT) AS count FROM c JOIN scoped USING (feed_id) GROUP BY ALL)"""


def rollup(spark, sf):
    return insights.category_rollup(counts.category_counts(M.opportunities(spark, sf)), M.feeds(spark, sf))


@Q.add(f"{ROLL} SELECT scope, category, value, count, round(count * 100.0 / sum(count) OVER (PARTITION BY scope, category), 4) AS percentage FROM r")
def category_scope_rollup(spark, sf):
    return rollup(spark, sf).withColumn("percentage", F.round("percentage", 4))


@Q.add(f"""{ROLL} SELECT scope, 'activity_facility' AS category, value, CAST(sum(count) AS BIGINT) AS count, round(sum(count) * 100.0 / sum(sum(count)) OVER (PARTITION BY scope), 4) AS percentage
    FROM r WHERE category IN ('activity', 'facility') GROUP BY scope, value""")
def activity_facility_merge(spark, sf):
    return insights.merged_categories(rollup(spark, sf), ("activity", "facility"), "activity_facility").withColumn("percentage", F.round("percentage", 4))


TOTALS = f"""t AS (SELECT scope, count(DISTINCT publisher_name) AS num_publishers, count(DISTINCT dataset_url) AS num_datasets, count(*) AS num_feeds, count(num_items) AS num_feeds_with_data,
    count(*) FILTER (num_future_opportunity_items > 0) AS num_feeds_with_future, CAST(coalesce(sum(num_items), 0) AS BIGINT) AS total_items,
    CAST(coalesce(sum(num_future_opportunity_items), 0) AS BIGINT) AS total_future, CAST(coalesce(sum(num_future_week_opportunity_items), 0) AS BIGINT) AS total_future_week
    FROM scoped LEFT JOIN (SELECT * EXCLUDE (dataset_url) FROM ({BASE})) USING (feed_id) GROUP BY scope)"""


@Q.add(f"{WITH}, f AS ({M.FEEDS}), {SCOPED}, {TOTALS} SELECT * FROM t")
def scope_totals(spark, sf):
    return insights.scope_totals(M.feeds(spark, sf), counts.base_metrics(M.opportunities(spark, sf), M.REF))


# areas: two halves by latitude and two by longitude, and a trust in the south
POINTS = f"SELECT feed_id, lat, lng FROM o WHERE l_partkey % 7 <> 0 UNION ALL SELECT feed_id, lat, lng FROM sub"
AREAS = f"""SELECT feed_id, 'region' AS category, CASE WHEN lat < 4.95 THEN 'south' ELSE 'north' END AS value FROM ({POINTS}) UNION ALL SELECT feed_id, 'district', CASE WHEN lng < 5.000005 THEN 'west' ELSE 'east' END FROM ({POINTS})
    UNION ALL SELECT feed_id, 'trust', 'T' FROM ({POINTS}) WHERE lat < 4.95"""
WHOLE = ROLL.replace(f"FROM ({ALL}) WHERE", f"FROM ({ALL} UNION ALL {AREAS}) WHERE")
COVERAGE = """mapping AS (SELECT p_name AS activity, CASE WHEN p_size % 5 = 0 THEN 'No Match' ELSE p_brand END AS sport FROM part WHERE p_partkey % 2 = 0 QUALIFY row_number() OVER (PARTITION BY p_name ORDER BY p_partkey) = 1),
    labels AS (SELECT value AS activity, sum(count) AS n FROM r WHERE scope = 'all' AND category IN ('activity', 'facility') GROUP BY value),
    sad AS (SELECT n, coalesce(sport, 'No Match') AS sport FROM labels LEFT JOIN mapping USING (activity)),
    sads AS (SELECT CAST(coalesce(sum(n) FILTER (sport <> 'No Match'), 0) AS BIGINT) AS total_num_items_with_sad, CAST(coalesce(sum(n) FILTER (sport = 'No Match'), 0) AS BIGINT) AS total_num_items_without_sad, count(*) FILTER (sport <> 'No Match') AS total_num_activities_with_sad,
      count(*) FILTER (sport = 'No Match') AS total_num_activities_without_sad, (SELECT count(DISTINCT p_brand) FROM part) AS num_sad, count(DISTINCT sport) FILTER (sport <> 'No Match') AS num_sad_matched FROM sad)"""
SUMMARY = f"""{WHOLE}, {TOTALS}, {COVERAGE} SELECT '1998-06-15' AS run_date,
    {', '.join(f"(SELECT coalesce(max({c}), 0) FROM t WHERE scope = '{s}') AS {name if s == 'all' else f'{name}_{s}'}" for c, name in insights.TOTAL_NAMES.items() for s in insights.SCOPES)},
    {', '.join(f"(SELECT count(*) FROM r WHERE scope = 'all' AND category = '{c}') AS total_num_{name}" for c, (name, _) in insights.CATEGORY_NAMES.items())},
    {', '.join(f"(SELECT CAST(coalesce(sum(count), 0) AS BIGINT) FROM r WHERE scope = 'all' AND category = '{c}') AS total_num_items_with_{name}" for c, (_, name) in insights.CATEGORY_NAMES.items())},
    sads.*, num_sad - num_sad_matched AS num_sad_unmatched, round(num_sad_matched * 100.0 / num_sad, 4) AS percentage_sad_matched, round(100 - num_sad_matched * 100.0 / num_sad, 4) AS percentage_sad_unmatched FROM sads"""


def insight_run(spark, sf):
    """The whole run, with areas and sports."""
    from ..config import EngineConfig
    from ..operators.spatial import RINGS
    from ..plans.insights import run

    def box(west, south, east, north):
        return [[{"lng": x, "lat": y} for x, y in ((west, south), (east, south), (east, north), (west, north))]]

    areas = {"region": [("south", box(-9.0, -1.0, 20.0, 4.95)), ("north", box(-9.0, 4.95, 20.0, 11.0))], "district": [("west", box(-9.0, -1.0, 5.000005, 11.0)), ("east", box(5.000005, -1.0, 20.0, 11.0))], "trust": [("T", box(-9.0, -1.0, 20.0, 4.95))]}
    layers = {name: spark.createDataFrame([(a, k, rings) for k, (a, rings) in enumerate(own)], f"area string, ordinal int, rings {RINGS}") for name, own in areas.items()}
    feeds = M.feeds(spark, sf).selectExpr("id", "dataset_url", "s_name AS dataset_name", "publisher_name", "provider", "type", "is_regular", "age AS last_access")
    log = M.log(spark, sf).withColumn("ingestion_date", F.expr("ingestion_date + make_dt_interval(0, 0, 0, cast(o_orderkey AS decimal(18, 6)) / 1000000)"))  # the later order counts
    brands = M.table(spark, sf, "part").select(F.col("p_brand").alias("sport_and_discipline")).distinct()
    return run(M.opportunities(spark, sf), feeds, log, EngineConfig(M.REF), layers, brands, sports(spark, sf))


@Q.add(SUMMARY)
def run_summary(spark, sf):
    out = insight_run(spark, sf).summary
    return out.withColumns({c: F.round(c, 4) for c in ("percentage_sad_matched", "percentage_sad_unmatched")}).withColumn("run_date", F.date_format("run_date", "yyyy-MM-dd"))


_MAPS = {"item_kind": "item_kinds", "item_type": "item_types", "organizer": "organizer_names", "activity": "activities", "facility": "facilities", "accessibility": "accessibilities", "region": "regions", "district": "districts", "trust": "trusts"}


@Q.add(f"""{WHOLE}, v AS (SELECT feed_id, category, string_agg(value || '=' || cnt, ',' ORDER BY value) AS counts FROM c GROUP BY ALL), b AS ({BASE}),
    st AS (SELECT feed_id, status FROM ({M.LOG}) QUALIFY row_number() OVER (PARTITION BY feed_id ORDER BY ingestion_date DESC, o_orderkey DESC) = 1)
    SELECT '1998-06-15' AS run_date, b.feed_id, b.dataset_url, s_name AS dataset_name, publisher_name, CAST(NULL AS VARCHAR) AS feed_url, CAST(NULL AS VARCHAR) AS license_url, CAST(NULL AS VARCHAR) AS logo_url, type AS feed_type, CAST(NULL AS VARCHAR) AS event_type,
      CAST(is_regular AS VARCHAR) AS is_regular, status, num_items, num_items AS num_analysis_items, {', '.join(f'num_{w}opportunity_items, num_{w}opportunity_items AS num_{w}opportunity_start_dates' for w in ('', 'future_', 'future_week_'))},
      {', '.join(f"coalesce((SELECT counts FROM v WHERE v.feed_id = b.feed_id AND category = '{c}'), '') AS {name}_counts" for c, name in _MAPS.items())}
    FROM b JOIN f ON f.feed_id = b.feed_id LEFT JOIN st ON st.feed_id = b.feed_id""")
def feed_insights(spark, sf):
    shown = lambda c: F.array_join(F.transform(F.array_sort(F.map_entries(c)), lambda e: F.concat_ws("=", e["key"], e["value"])), ",")
    out = insight_run(spark, sf).feeds
    return out.withColumns({f"{name}_counts": shown(f"{name}_counts") for name in _MAPS.values()} | {"run_date": F.date_format("run_date", "yyyy-MM-dd"), "is_regular": F.col("is_regular").cast("string")})


@Q.add(f"""WITH {M.O}, fd AS (SELECT dataset_url, publisher_name, provider FROM ({M.FEEDS}) QUALIFY row_number() OVER (PARTITION BY dataset_url ORDER BY age DESC, id DESC) = 1),
    b AS (SELECT c_mktsegment AS district_name, publisher_name AS publisher, provider, kind NOT IN ('FacilityUse', 'IndividualFacilityUse', 'Slot') AS is_activity,
                 '["' || CASE WHEN kind = 'SessionSeries' THEN p_name ELSE p_type END || '"]' AS activity_or_facility, nullif(p_brand, 'Brand#11') AS organization_name
          FROM o LEFT JOIN fd USING (dataset_url) WHERE start_date >= DATE '1998-06-15' AND publisher_name IS NOT NULL)
    SELECT district_name, publisher, provider, is_activity, activity_or_facility, count(*) AS opportunity_count,
           '[' || coalesce(string_agg(DISTINCT '"' || organization_name || '"', ',' ORDER BY '"' || organization_name || '"'), '') || ']' AS organization_names FROM b GROUP BY ALL""")
def active_opportunities_summary(spark, sf):
    rows = M.opportunities(spark, sf).selectExpr("*", "c_mktsegment AS district_name", "cast(null AS string) AS nhstrust_name", "cast(null AS string) AS nhstrust_code", "nullif(p_brand, 'Brand#11') AS organization_name")
    feeds = M.feeds(spark, sf).withColumnRenamed("age", "last_access")
    return insights.active_summary(rows, feeds, M.REF).drop("nhstrust_name", "nhstrust_code")


SAD = f"""{WITH}, labels AS (SELECT value AS activity, count(*) AS count FROM ({ACTIVITIES}) GROUP BY value),
    mapping AS (SELECT DISTINCT p_name AS activity, CASE WHEN p_size % 5 = 0 THEN 'No Match' ELSE p_brand END AS sport_and_discipline, p_partkey FROM part
                WHERE p_partkey % 2 = 0 QUALIFY row_number() OVER (PARTITION BY p_name ORDER BY p_partkey) = 1),
    j AS (SELECT l.activity, l.count, m.sport_and_discipline FROM labels l LEFT JOIN mapping m USING (activity))"""


def labels(spark, sf):
    return counts.counts_of(M.opportunities(spark, sf), "activity").groupBy(F.col("value").alias("activity")).agg(F.sum("cnt").alias("count"))


def sports(spark, sf):
    part = M.table(spark, sf, "part").where("p_partkey % 2 = 0")
    first = part.groupBy(F.col("p_name").alias("activity")).agg(F.min_by(F.struct("p_size", "p_brand"), "p_partkey").alias("p"))
    return first.select("activity", F.when(F.col("p.p_size") % 5 == 0, "No Match").otherwise(F.col("p.p_brand")).alias("sport_and_discipline"))


@Q.add(f"""{SAD}, m AS (SELECT sport_and_discipline, string_agg(activity, '; ' ORDER BY count DESC, activity) AS activity, count(*) AS count_activities, CAST(sum(count) AS BIGINT) AS count_items
    FROM j WHERE sport_and_discipline <> 'No Match' GROUP BY 1)
    SELECT *, round(count_activities * 100.0 / sum(count_activities) OVER (), 4) AS percentage_activities, round(count_items * 100.0 / sum(count_items) OVER (), 4) AS percentage_items FROM m""")
def sad_matched(spark, sf):
    return sad.matched(labels(spark, sf), sports(spark, sf)).withColumns({c: F.round(c, 4) for c in ("percentage_activities", "percentage_items")})


@Q.add(f"""{SAD} SELECT 'No Match' AS sport_and_discipline, activity, count AS count_items, round(count * 100.0 / sum(count) OVER (), 4) AS percentage_items
    FROM j WHERE coalesce(sport_and_discipline, 'No Match') = 'No Match'""")
def sad_unmatched(spark, sf):
    return sad.unmatched(labels(spark, sf), sports(spark, sf)).withColumn("percentage_items", F.round("percentage_items", 4))


@Q.add(f"""{SAD} SELECT DISTINCT p_brand AS sport_and_discipline, p_brand IN (SELECT sport_and_discipline FROM j WHERE sport_and_discipline IS NOT NULL) AS is_matched_by_any_feed FROM part""")
def sad_master(spark, sf):
    brands = M.table(spark, sf, "part").select(F.col("p_brand").alias("sport_and_discipline")).distinct()
    return sad.master(brands, sad.matched(labels(spark, sf), sports(spark, sf)))


@Q.add(f"""{SAD}, c AS (SELECT count(DISTINCT sport_and_discipline) AS num_sad_matched, count(*) AS a, sum(count) AS i FROM j WHERE sport_and_discipline <> 'No Match'),
    u AS (SELECT count(*) AS ua, sum(count) AS ui FROM j WHERE coalesce(sport_and_discipline, 'No Match') = 'No Match'), n AS (SELECT count(DISTINCT p_brand) AS num_sad FROM part)
    SELECT num_sad_matched, a AS total_num_activities_with_sad, CAST(i AS BIGINT) AS total_num_items_with_sad, ua AS total_num_activities_without_sad, CAST(ui AS BIGINT) AS total_num_items_without_sad,
           num_sad, num_sad - num_sad_matched AS num_sad_unmatched, round(num_sad_matched * 100.0 / num_sad, 4) AS percentage_sad_matched, round(100 - num_sad_matched * 100.0 / num_sad, 4) AS percentage_sad_unmatched FROM c, u, n""")
def sad_coverage(spark, sf):
    brands = M.table(spark, sf, "part").select(F.col("p_brand").alias("sport_and_discipline")).distinct()
    own, also = labels(spark, sf), sports(spark, sf)
    return sad.coverage(brands, sad.matched(own, also), sad.unmatched(own, also)).withColumns({c: F.round(c, 4) for c in ("percentage_sad_matched", "percentage_sad_unmatched")})


