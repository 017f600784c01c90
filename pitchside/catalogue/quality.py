"""Quality and field usage: line items with fields left out by a modulus."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from .. import specs
from ..operators import field_usage, quality
from . import mapping as M

Q = M.Registry()
REF = date(1998, 6, 15)

FULL = f"""SELECT CAST(s_nationkey AS VARCHAR) AS dataset_url, CAST(l_suppkey AS VARCHAR) AS feed_id, {M.KIND} AS kind, CAST(l_shipdate AS DATE) AS last_updated, l_partkey AS k FROM lineitem JOIN supplier ON s_suppkey = l_suppkey"""
_RULES = (("location", "k % 3 <> 0 AND k % 5 <> 0"), ("start_date", "k % 4 <> 0"), ("end_date", "k % 2 = 0"), ("activities", "k % 7 = 1"), ("facilities", "k % 6 = 1"), ("age_range", "k % 5 = 0"), ("level", "k % 8 > 3"), ("accessibility_support", "k % 9 = 0"), ("gender_restriction", "k % 10 > 2"))


@Q.add(f"""SELECT dataset_url, feed_id, count(*) AS total_items, {', '.join(f'round(count(*) FILTER ({rule}) * 100.0 / count(*), 4) AS {name}_completeness' for name, rule in _RULES)}
    FROM ({FULL}) WHERE last_updated >= DATE '1998-06-15' - 5 GROUP BY ALL""")
def completeness(spark, sf):
    rows = full(spark, sf).selectExpr(
        "dataset_url", "feed_id", "last_updated", "CASE WHEN k % 3 = 0 THEN 'null' WHEN k % 5 = 0 THEN '{}' ELSE '{\"a\":1}' END AS location", "CASE WHEN k % 4 <> 0 THEN timestamp '2020-01-01' END AS startDate",
        "CASE WHEN k % 2 = 0 THEN timestamp '2020-01-01' END AS endDate", "CASE WHEN k % 7 = 1 THEN array('a') WHEN k % 7 = 2 THEN array() END AS activity", "CASE WHEN k % 6 = 1 THEN array('f') END AS facility",
        "CASE WHEN k % 5 = 0 THEN '{\"min\":1}' WHEN k % 5 = 1 THEN '{}' END AS ageRange", "CASE k % 8 WHEN 0 THEN 'null' WHEN 1 THEN '[]' WHEN 2 THEN '\"\"' WHEN 3 THEN NULL ELSE '\"x\"' END AS level",
        "CASE WHEN k % 9 = 0 THEN array('s') ELSE array() END AS accessibilitySupport", "CASE WHEN k % 10 > 2 THEN 'F' WHEN k % 10 = 1 THEN '' END AS genderRestriction",
    )
    return quality.completeness(rows, REF).select("dataset_url", "feed_id", "total_items", *(F.round(f"{n}_completeness", 4).alias(f"{n}_completeness") for n, _ in _RULES))


def full(spark, sf):
    for name in ("lineitem", "supplier"):
        M.table(spark, sf, name).createOrReplaceTempView(name)
    return spark.sql(FULL.replace("VARCHAR", "STRING"))


def samples(spark, sf):
    """Payloads whose keys depend on the part: every feed has a type of its own."""
    given = "named_struct('@type', CASE WHEN k % 4 <> 0 THEN kind END, '@id', CASE WHEN k % 3 = 0 THEN 'i' END, 'name', CASE WHEN feed_id % 5 <> 0 THEN 'n' END, 'url', CASE WHEN k % 2 = 0 THEN 'u' END, 'location', CASE WHEN feed_id % 3 <> 0 THEN named_struct('a', k) END, 'organizer', CASE WHEN feed_id % 7 = 0 THEN 'o' END, 'startDate', CASE WHEN k % 5 = 0 THEN 'd' END, 'duration', 'PT1H', 'offers', CASE WHEN feed_id % 2 = 0 THEN 1 END, 'facilityUse', 'f', 'activity', CASE WHEN k % 6 = 0 THEN 'a' END, 'provider', 'p')"
    return full(spark, sf).selectExpr("dataset_url", "feed_id", "kind", "k", "cast(null AS string) AS feed_type", "monotonically_increasing_id() AS seq", f"to_json({given}) AS json_data")


# what a payload's keys are, on plain columns
_KEYS = {"@type": "k % 4 <> 0", "@id": "k % 3 = 0", "name": "CAST(feed_id AS INTEGER) % 5 <> 0", "url": "k % 2 = 0", "location": "CAST(feed_id AS INTEGER) % 3 <> 0", "organizer": "CAST(feed_id AS INTEGER) % 7 = 0", "startDate": "k % 5 = 0", "duration": "true", "offers": "CAST(feed_id AS INTEGER) % 2 = 0", "facilityUse": "true", "activity": "k % 6 = 0", "provider": "true"}


def one_type(spark, sf, category):
    rows = samples(spark, sf).withColumn("feed_type", F.lit(category))
    return quality.item_categories(rows)


def _score(category: str, version: str) -> str:
    parts = []
    for prop, status in specs.properties(category, version).items():
        yes, no = specs.WEIGHTS[status]
        parts.append(f"CASE WHEN {_KEYS[prop]} THEN {yes} ELSE {no} END" if prop in _KEYS else str(no))
    return " + ".join(f"({p})" for p in parts)


def _share(category: str, version: str, status: str) -> str:
    own = [p for p, s in specs.properties(category, version).items() if s == status]
    return f"({' + '.join(f'CASE WHEN {_KEYS[p]} THEN 1 ELSE 0 END' for p in own if p in _KEYS) or '0'}) * 100.0 / {len(own)}"


_SLOT = "SELECT dataset_url, feed_id, 'Slot' AS category, '{v}' AS version, round(avg({s}), 6) AS score, round(avg({r}), 6) AS required_pct, round(avg({c}), 6) AS recommended_pct FROM ({f}) GROUP BY ALL"


@Q.add(" UNION ALL ".join(_SLOT.format(v=v, s=_score("Slot", v), r=_share("Slot", v, "required"), c=_share("Slot", v, "recommended"), f=FULL) for v in specs.versions("Slot")))
def version_score(spark, sf):
    scores = quality.version_scores(one_type(spark, sf, "Slot"))
    return scores.select("dataset_url", "feed_id", "category", "version", *(F.round(c, 6).alias(c) for c in ("score", "required_pct", "recommended_pct")))


_V = [f"SELECT dataset_url, feed_id, {k} AS ordinal, '{v}' AS version, avg({_score('Event', v)}) AS score, avg({_share('Event', v, 'required')}) AS req, max(CAST(feed_id AS INTEGER)) % 2 = 0 AS offers FROM f GROUP BY ALL" for k, v in enumerate(specs.versions("Event"))]
_BOUNDS = " ".join(f"WHEN '{v}' THEN (score - {specs.bounds('Event', v)[0]}) / {specs.bounds('Event', v)[1] - specs.bounds('Event', v)[0]} * 100" for v in specs.versions("Event"))


@Q.add(f"""WITH f AS (SELECT * REPLACE ('Event' AS kind) FROM ({FULL})), s AS ({' UNION ALL '.join(_V)}),
    b AS (SELECT dataset_url, feed_id, arg_max(version, score * 1000 - ordinal * 0.000001) AS best, arg_max(version, score * 1000 - ordinal * 0.000001) FILTER (version LIKE 'V2%') AS best2, bool_or(offers) AS offers FROM s GROUP BY ALL),
    c AS (SELECT dataset_url, feed_id, CASE WHEN offers AND best LIKE 'V1%' THEN best2 WHEN best = 'V1.0' THEN 'V1.1' ELSE best END AS version FROM b)
    SELECT c.dataset_url, c.feed_id, CASE WHEN c.version LIKE 'V1%' AND req < 50 THEN 'V0.x' ELSE c.version END AS version,
           CASE WHEN NOT (c.version LIKE 'V1%' AND req < 50) THEN round(greatest(0, least(100, CASE c.version {_BOUNDS} END)), 1) END AS score FROM c JOIN s USING (dataset_url, feed_id, version)""")
def version_detect(spark, sf):
    rows = samples(spark, sf).withColumn("kind", F.lit("Event")).withColumn("feed_type", F.lit("Event"))
    rows = rows.withColumn("json_data", F.regexp_replace("json_data", '"@type":"[A-Za-z]+"', '"@type":"Event"'))
    items = quality.item_categories(rows)
    return quality.detect_versions(items, quality.version_scores(items)).select("dataset_url", "feed_id", "version", "score")


_MISS = " ".join(f"WHEN '{k}' THEN concat_ws(',', {', '.join((f'''CASE WHEN NOT bool_or({_KEYS[p]}) THEN '{p}' END''' if p in _KEYS else f"'{p}'") for p in specs.REQUIRED_BY_KIND[k])})" for k in ("Slot", "FacilityUse", "SessionSeries"))


@Q.add(f"SELECT * FROM (SELECT dataset_url, feed_id, kind, CASE kind {_MISS} END AS missing FROM ({FULL}) GROUP BY dataset_url, feed_id, kind) WHERE missing <> ''")
def missing_required_fields(spark, sf):
    return quality.missing_required(samples(spark, sf)).withColumn("missing", F.array_join("missing", ","))


FEED = f"""SELECT feed_id, type AS feed_type, CASE CAST(feed_id AS INTEGER) % 5 WHEN 0 THEN 'ERROR' WHEN 1 THEN 'WARNING' ELSE 'COMPLETE' END AS ingestion_status,
    CASE CAST(feed_id AS INTEGER) % 7 WHEN 0 THEN 'empty' WHEN 1 THEN 'http_error' WHEN 2 THEN 'ok' END AS probe_kind, 'said ' || feed_id AS probe_message,
    CASE WHEN CAST(feed_id AS INTEGER) % 3 = 0 THEN 'Slot: a, b' END AS missing_text, CAST(feed_id AS INTEGER) % 4 * 60 AS num_future FROM ({M.FEEDS})"""


def classified(spark, sf):
    M.feeds(spark, sf)
    return quality.classify(spark.sql(FEED.replace("VARCHAR", "STRING")))


_IDLE = "(num_future = 0 AND coalesce(feed_type, '') NOT IN ('FacilityUse', 'SessionSeries'))"
STATUS = f"""SELECT *, CASE WHEN ingestion_status = 'ERROR' THEN CASE WHEN probe_kind IN ('http_error', 'parse_error', 'empty') THEN probe_message ELSE 'Data parsing error (invalid JSON or missing ''items'')' END
      WHEN probe_kind IN ('http_error', 'parse_error') AND (ingestion_status = 'WARNING' OR {_IDLE}) THEN probe_message ELSE '' END AS errors,
    CASE WHEN ingestion_status = 'ERROR' THEN '' ELSE concat_ws('|', 'Missing required fields — ' || missing_text, CASE WHEN probe_kind = 'empty' AND (ingestion_status = 'WARNING' OR {_IDLE}) THEN probe_message END,
      CASE WHEN {_IDLE} AND coalesce(probe_kind, '') NOT IN ('empty', 'http_error', 'parse_error') THEN 'No future opportunities scheduled' END) END AS warnings FROM ({FEED})"""


@Q.add(f"SELECT feed_id, errors, warnings, CASE WHEN errors <> '' THEN 'ERROR' WHEN warnings <> '' THEN 'WARNING' ELSE 'OK' END AS status FROM ({STATUS})")
def classify_status(spark, sf):
    return classified(spark, sf).select("feed_id", F.array_join("errors", "|").alias("errors"), F.array_join("warnings", "|").alias("warnings"), "status")


@Q.add(f"""SELECT s_suppkey, CASE WHEN n <> 0 AND s_suppkey % 11 <> 0 THEN CASE WHEN n > 150 AND a >= 40 AND b >= 40 AND (c >= 5 OR d >= 5) AND NOT m THEN 'Gold' WHEN a >= 25 AND b >= 15 AND NOT m THEN 'Silver' ELSE 'Bronze' END END AS grade
    FROM (SELECT s_suppkey, s_suppkey * 13 % 400 AS n, s_suppkey * 7 % 100 AS a, s_suppkey * 11 % 100 AS b, s_suppkey % 12 AS c, s_suppkey * 3 % 9 AS d, s_suppkey % 6 = 0 AS m FROM supplier)""")
def grade_feed(spark, sf):
    k = F.col("s_suppkey")
    status = F.when(k % 11 == 0, "WARNING").otherwise("OK")
    return M.table(spark, sf, "supplier").select("s_suppkey", quality.grade(status, k * 13 % 400, k * 7 % 100, k * 11 % 100, k % 12, k * 3 % 9, k % 6 == 0).alias("grade"))


@Q.add()
def feed_quality(spark, sf):
    """The whole assessment, from opportunities to grades."""
    from ..config import EngineConfig
    from ..plans.insights import assess

    rows = M.opportunities(spark, sf).selectExpr("*", "cast(l_shipdate AS date) AS last_updated", "start_date AS endDate", "CASE WHEN l_partkey % 5 = 0 THEN '{\"min\":1}' END AS ageRange", "cast(null AS string) AS level", "cast(null AS array<string>) AS accessibilitySupport", "'F' AS genderRestriction")
    feeds = M.feeds(spark, sf).select("feed_id", "dataset_url", F.col("type").alias("feed_type"), "is_regular")
    probes = feeds.select("feed_id", F.lit("ok").alias("probe_kind"), F.lit("").alias("probe_message"))
    return assess(rows, feeds, M.log(spark, sf), probes, EngineConfig(REF))


# --- field usage: three typed objects in every payload
MODEL = [("Event", "name", "required"), ("Event", "url", "required"), ("Event", "level", "optional"), ("Event", "@id", "recommended"), ("Slot", "duration", "required"), ("Slot", "remainingUses", "required"), ("Place", "geo", "optional")]
CATEGORY = {"SessionSeries": "Event", "FacilityUse": "Event", "Slot": "Slot", "Place": "Place"}
ALSO = {("Event", "@id"): ("id",), ("Slot", "@id"): ("id",)}
_F = {"name": "k % 2 = 0", "id": "k % 3 = 0", "duration": "k % 5 = 0", "location": "true", "extra": "k % 97 = 0"}
_TOP = f"SELECT dataset_url, kind AS type, k FROM ({FULL})"
_PLACE = f"SELECT dataset_url, 'Place' AS type, k FROM ({FULL}) WHERE k % 4 <> 0"
_NEW = f"SELECT dataset_url, 'Amenity' AS type, k FROM ({FULL}) WHERE k % 4 <> 0 AND k % 6 = 0"
_RAW = " UNION ALL ".join([f"SELECT type, '{f}' AS field, k FROM ({_TOP}) WHERE {c}" for f, c in _F.items()] + [f"SELECT type, 'geo', k FROM ({_PLACE}) WHERE k % 7 <> 0", f"SELECT type, 'amenity', k FROM ({_PLACE}) WHERE k % 6 = 0", f"SELECT type, 'value', k FROM ({_NEW})"])
_ENT = f"SELECT type FROM ({_TOP}) UNION ALL SELECT type FROM ({_PLACE}) UNION ALL SELECT type FROM ({_NEW})"


def walked(spark, sf):
    place = "named_struct('type', CASE WHEN k % 4 <> 0 THEN 'Place' END, 'geo', CASE WHEN k % 4 = 0 OR k % 7 <> 0 THEN 1 END, 'amenity', CASE WHEN k % 4 <> 0 AND k % 6 = 0 THEN array(named_struct('@type', array('Amenity'), 'value', true)) END)"
    given = "named_struct('@context', 'c', 'name', CASE WHEN k % 2 = 0 THEN 'n' END, 'id', CASE WHEN k % 3 = 0 THEN 'i' END, 'duration', CASE WHEN k % 5 = 0 THEN 'd' END, 'extra', CASE WHEN k % 97 = 0 THEN 1 END"
    return field_usage.walk(full(spark, sf).selectExpr("dataset_url", "kind", f"to_json({given}, 'location', {place})) AS json_data"))


def model(spark):
    return spark.createDataFrame(MODEL, "category string, field string, model_status string")


@Q.add(f"""SELECT type, field, instances_with, total_instances FROM (SELECT type, field, count(*) AS instances_with FROM ({_RAW}) GROUP BY ALL) JOIN (SELECT type, count(*) AS total_instances FROM ({_ENT}) GROUP BY ALL) USING (type)""")
def field_usage_raw(spark, sf):
    return field_usage.tallies(walked(spark, sf))


_CAT = "CASE type WHEN 'SessionSeries' THEN 'Event' WHEN 'FacilityUse' THEN 'Event' WHEN 'Slot' THEN 'Slot' WHEN 'Place' THEN 'Place' END"
_CLASS = "CASE WHEN instances_with = 0 THEN 'UNUSED' WHEN instances_with * 100.0 / total_instances < 1 THEN 'RARE' WHEN instances_with * 100.0 / total_instances < 10 THEN 'LOW' ELSE 'COMMON' END AS classification"
_TOT = f"SELECT {_CAT} AS category, count(*) AS total_instances FROM ({_ENT}) WHERE {_CAT} IS NOT NULL GROUP BY ALL"


@Q.add(f"""WITH m(category, field, model_status) AS (VALUES {', '.join(str(x) for x in MODEL)}), r AS (SELECT {_CAT} AS category, CASE WHEN field = 'id' THEN '@id' ELSE field END AS field, count(*) AS n FROM ({_RAW}) GROUP BY ALL), t AS ({_TOT}),
    j AS (SELECT category, field, model_status, coalesce(n, 0) AS instances_with, total_instances FROM m JOIN t USING (category) LEFT JOIN r USING (category, field))
    SELECT *, round(instances_with * 100.0 / total_instances, 4) AS presence_pct, {_CLASS} FROM j""")
def field_usage_model(spark, sf):
    return field_usage.model_usage(walked(spark, sf), model(spark), CATEGORY, ALSO).withColumn("presence_pct", F.round("presence_pct", 4))


@Q.add(f"""WITH r AS (SELECT {_CAT} AS category, field, count(*) AS instances_with FROM ({_RAW}) GROUP BY ALL), t AS ({_TOT}), k(category, field) AS (VALUES {', '.join(str(x[:2]) for x in MODEL)}, ('Event', 'id'), ('Slot', 'id'))
    SELECT r.*, total_instances, round(instances_with * 100.0 / total_instances, 4) AS presence_pct, {_CLASS} FROM r JOIN t USING (category) WHERE (category, field) NOT IN (SELECT (category, field) FROM k)""")
def field_extensions(spark, sf):
    return field_usage.extensions(walked(spark, sf), model(spark), CATEGORY, ALSO).withColumn("presence_pct", F.round("presence_pct", 4))


@Q.add(f"SELECT 'Amenity' AS type, 'value' AS field, count(*) AS instances_with, count(*) AS total_instances, CAST(100 AS DOUBLE) AS presence_pct, 'COMMON' AS classification FROM ({_NEW}) HAVING count(*) > 0")
def field_discovered(spark, sf):
    return field_usage.discovered(walked(spark, sf), CATEGORY)


_EXACT = {"Slot": ("duration", "name"), "SessionSeries": ("name", "url", "extra")}


@Q.add(" UNION ALL ".join(f"SELECT kind, '{f}' AS field, count(*) AS total_instances, count(*) FILTER ({_F.get(f, 'false')}) AS instances_with FROM ({FULL}) WHERE kind = '{k}' GROUP BY kind" for k, own in _EXACT.items() for f in own))
def field_presence_exact(spark, sf):
    rows = full(spark, sf).selectExpr("kind", "to_json(named_struct('name', CASE WHEN k % 2 = 0 THEN 'n' END, 'duration', CASE WHEN k % 5 = 0 THEN 'd' END, 'extra', CASE WHEN k % 97 = 0 THEN 1 END)) AS json_data")
    return field_usage.exact_presence(rows, _EXACT).select("kind", "field", "total_instances", "instances_with")


_RAWD = " UNION ALL ".join([f"SELECT dataset_url, type, '{f}' AS field FROM ({_TOP}) WHERE {c}" for f, c in _F.items()] + [f"SELECT dataset_url, type, 'geo' FROM ({_PLACE}) WHERE k % 7 <> 0", f"SELECT dataset_url, type, 'amenity' FROM ({_PLACE}) WHERE k % 6 = 0", f"SELECT dataset_url, type, 'value' FROM ({_NEW})"])
_ENTD = " UNION ALL ".join(f"SELECT dataset_url, type FROM ({x})" for x in (_TOP, _PLACE, _NEW))


@Q.add(f"""WITH n AS (SELECT dataset_url, type, field, count(*) AS n FROM ({_RAWD}) GROUP BY ALL), t AS (SELECT dataset_url, type, count(*) AS instances FROM ({_ENTD}) GROUP BY ALL), m(category, field, model_status) AS (VALUES {', '.join(str(x) for x in MODEL)}),
    a AS (SELECT t.dataset_url, t.type, string_agg(m.field, ',' ORDER BY m.field) FILTER (n.n IS NULL) AS absent FROM (SELECT *, {_CAT} AS category FROM t) t JOIN m USING (category) LEFT JOIN n ON n.dataset_url = t.dataset_url AND n.type = t.type AND n.field = m.field GROUP BY ALL),
    p AS (SELECT dataset_url, max(publisher_name) AS publisher_name FROM ({M.FEEDS}) GROUP BY dataset_url)
    SELECT dataset_url, publisher_name, type, instances, string_agg(field || '=' || n, ',' ORDER BY n DESC, field) AS present, CASE WHEN {_CAT} IS NOT NULL THEN coalesce(any_value(absent), '') END AS absent
    FROM n JOIN t USING (dataset_url, type) LEFT JOIN a USING (dataset_url, type) LEFT JOIN p USING (dataset_url) GROUP BY dataset_url, publisher_name, type, instances""")
def field_dataset_reports(spark, sf):
    """Per dataset and type, the fields used and those of the model that are not."""
    out = field_usage.dataset_reports(walked(spark, sf), model(spark), CATEGORY, M.feeds(spark, sf))
    used = F.transform("present", lambda x: F.concat_ws("=", x["field"], F.round(x["pct"] * F.col("instances") / 100).cast("bigint")))
    return out.withColumn("present", F.array_join(used, ",")).withColumn("absent", F.array_join("absent", ","))
