"""Payload shapes, addresses, dates and coercions."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import schemas
from ..functions import payload as P
from ..functions import text as X
from ..sources import html as H
from . import mapping as M

Q = M.Registry()
SPEC = r"^https?://[^/]*/[a-z]+/[0-9]+/?$"


def urls(spark, sf):
    return M.table(spark, sf, "pages").select("page_id", "url")


@Q.add(r"SELECT page_id, trim(translate(regexp_replace(regexp_replace(url, '^https?://', ''), '^www\.', ''), './', '--'), '-') AS feed_id FROM pages")
def feed_id(spark, sf):
    return urls(spark, sf).select("page_id", X.feed_id(F.col("url")).alias("feed_id"))


@Q.add(r"SELECT page_id, regexp_replace(regexp_extract(url, '^[a-z]+://([^/?#]*)', 1), '^www\.', '') AS provider FROM pages")
def provider(spark, sf):
    return urls(spark, sf).select("page_id", X.provider(F.col("url")).alias("provider"))


@Q.add(r"""SELECT page_id, url || CASE WHEN contains(url, '?') THEN '&' ELSE '?' END || CASE WHEN page_id % 3 = 0 THEN 'afterChangeNumber=' || page_id WHEN page_id % 3 = 1 THEN 'afterTimestamp=t' || page_id || '&afterId=i' END AS next FROM pages WHERE page_id % 3 < 2
    UNION ALL SELECT page_id, url FROM pages WHERE page_id % 3 = 2""")
def initial_url(spark, sf):
    k = F.col("page_id")
    return urls(spark, sf).select("page_id", X.first_url(F.col("url"), F.when(k % 3 < 2, F.concat(F.lit("t"), k)), F.when(k % 3 == 1, "i"), F.when(k % 3 == 0, k)).alias("next"))


@Q.add("SELECT page_id, CASE WHEN page_id % 3 = 1 THEN 't' || page_id END AS afterTimestamp, CASE WHEN page_id % 3 = 1 THEN 'i' END AS afterId, CASE WHEN page_id % 3 = 0 THEN page_id ELSE -1 END AS afterChangeNumber FROM pages")
def cursor_parse(spark, sf):
    c = X.cursor(F.col("next"))
    return initial_url(spark, sf).select("page_id", c["afterTimestamp"].alias("afterTimestamp"), c["afterId"].alias("afterId"), F.coalesce(c["afterChangeNumber"], F.lit(-1)).alias("afterChangeNumber"))


@Q.add("SELECT page_id, len(regexp_extract_all(html, '(?is)<a\\b[^>]*?\\bhref\\s*=\\s*[\"'']?([^\"''\\s>]+)', 1)) AS links FROM pages")
def html_links(spark, sf):
    return M.table(spark, sf, "pages").select("page_id", F.size(H.links(F.col("html"))).cast("bigint").alias("links"))


@Q.add("SELECT page_id, 'https://spec.example.org/model/' || page_id || '/' AS spec FROM pages")
def spec_links(spark, sf):
    page = F.concat(F.lit('<a href="https://spec.example.org/rpde/1">x</a><p>Data <b>Published using</b> <a href="http://www.Spec.example.org/model/'), "page_id", F.lit('">m</a></p>'))
    return M.table(spark, sf, "pages").select("page_id", H.spec_links(page, r"(?i)^https?://(?:www\.)?spec\.example\.org/model/\d+/?$").alias("spec"))


@Q.add("SELECT 'https://d/' || c_custkey AS dataset_url, 'https://c/' || max(c_nationkey // 5 * 5 + 4 - 4 * (c_custkey % 2)) AS catalogue_url FROM customer GROUP BY c_custkey")
def catalogue_walk(spark, sf):
    rows = M.table(spark, sf, "customer").select(F.floor(F.col("c_nationkey") / 5).cast("int").alias("g"), "c_custkey")
    # each dataset is named by its group's first catalogue, and the even ones by its last, too
    named = rows.select((F.col("g") * 5).alias("c"), "c_custkey").unionByName(rows.where("c_custkey % 2 = 0").select((F.col("g") * 5 + 4).alias("c"), "c_custkey"))
    catalogues = named.groupBy("c").agg(F.to_json(F.struct(F.collect_list(F.concat(F.lit("https://d/"), "c_custkey")).alias("dataset"))).alias("payload")).select(F.concat(F.lit("https://c/"), "c").alias("url"), "payload")
    collection = spark.range(1).select(F.to_json(F.struct(F.array(*(F.struct(F.lit(f"https://c/{k}").alias("@id")) for k in range(25))).alias("hasPart"))).alias("payload"))
    return H.walk_catalogues(collection, catalogues)


@Q.add("SELECT 'https://f/' || s_suppkey AS url, CASE WHEN s_suppkey % 3 = 0 THEN 'Slot' WHEN s_suppkey % 3 = 1 THEN 'ScheduledSession' ELSE '' END AS type, s_name AS dataset_name, 'f-' || s_suppkey AS id FROM supplier")
def dataset_feeds(spark, sf):
    name = F.when(F.col("s_suppkey") % 3 == 0, "FacilityUse Slots").when(F.col("s_suppkey") % 3 == 1, "Scheduled Sessions").otherwise("Foo")
    ld = F.to_json(F.struct(F.col("s_name").alias("name"), F.array(F.struct(name.alias("name"), F.concat(F.lit("https://f/"), "s_suppkey").alias("contentUrl"))).alias("distribution")))
    pages = M.table(spark, sf, "supplier").select(F.concat(F.lit("https://p/"), "s_suppkey").alias("url"), F.concat(F.lit('<html><script type="application/ld+json">'), ld, F.lit("</script></html>")).alias("html"))
    return H.feeds_of(pages).select("url", "type", "dataset_name", "id")


@Q.add("SELECT event_id, json_extract_string(props, '$.k') AS k FROM events")
def json_extract(spark, sf):
    return M.table(spark, sf, "events").select("event_id", P.scalar(P.variant(F.col("props")), "$.k").alias("k"))


# the same label as an object, a text, a mixed list, an empty list and a number
_SHAPE = """CASE p_size % 5 WHEN 0 THEN '{"prefLabel":"' || p_name || '"}' WHEN 1 THEN '"' || p_name || '"' WHEN 2 THEN '[{"prefLabel":"' || p_name || '"},"' || p_brand || '",{"id":1},""]' WHEN 3 THEN '[]' ELSE '5' END"""


@Q.add("""SELECT p_partkey, CASE p_size % 5 WHEN 0 THEN p_name WHEN 1 THEN p_name WHEN 2 THEN p_name || ',' || p_brand ELSE '' END AS activity, CASE p_size % 5 WHEN 0 THEN p_name WHEN 1 THEN p_name WHEN 2 THEN p_name || ',' || p_brand WHEN 3 THEN 'Pool' ELSE '' END AS facility,
    CASE p_size % 5 WHEN 0 THEN p_name WHEN 2 THEN p_name || ',' || p_brand END AS accessibility, CASE WHEN p_size % 2 = 0 THEN p_type END AS organizer FROM part""")
def json_shapes(spark, sf):
    organizer = "CASE WHEN p_size % 2 = 0 THEN '\"\"' ELSE '\"https://x\"' END"
    rows = M.table(spark, sf, "part").selectExpr("p_partkey", f"""'{{"activity":' || {_SHAPE} || ',"facilityType":' || {_SHAPE} || ',"category":"Pool","accessibilitySupport":' || {_SHAPE} || ',"organizer":' || {organizer} || ',"provider":{{"name":" ' || p_type || ' "}}}}' AS j""")
    v = P.variant(F.col("j"))
    return rows.select("p_partkey", F.array_join(P.activities(v), ",").alias("activity"), F.array_join(P.facilities(v), ",").alias("facility"), F.array_join(P.accessibility(v), ",").alias("accessibility"), P.organization_name(v).alias("organizer"))


@Q.add("SELECT o_orderkey, o_orderpriority AS bare FROM orders")
def strip_quotes(spark, sf):
    return M.table(spark, sf, "orders").select("o_orderkey", P.strip_quotes(F.concat(F.lit('"'), "o_orderpriority", F.lit('"'))).alias("bare"))


@Q.add("SELECT o_orderkey, strftime(CASE WHEN o_orderkey % 2 = 0 THEN o_orderdate - INTERVAL 3 DAY ELSE DATE '2026-01-01' END, '%Y-%m-%d') AS first, strftime(CASE WHEN o_orderkey % 2 = 0 THEN o_orderdate + INTERVAL 9 DAY END, '%Y-%m-%d') AS last FROM orders")
def event_schedule_range(spark, sf):
    day = lambda n: F.date_format(F.date_add("o_orderdate", n), "yyyy-MM-dd")
    schedule = F.when(F.col("o_orderkey") % 2 == 0, F.array(F.struct(day(0).alias("startDate"), day(9).alias("endDate")), F.struct(F.concat(day(-3), F.lit("T10:00:00Z")).alias("startDate"), day(2).alias("endDate"))))
    rows = M.table(spark, sf, "orders").select("o_orderkey", F.to_json(F.struct(F.lit("2026-01-01").alias("startDate"), schedule.alias("eventSchedule"))).alias("j"))
    start, end = P.dates(P.variant(F.col("j")))
    return rows.select("o_orderkey", F.date_format(start, "yyyy-MM-dd").alias("first"), F.date_format(end, "yyyy-MM-dd").alias("last"))


@Q.add("SELECT s_suppkey, 'LS' || (s_suppkey % 9 + 1) || ' 4AP' AS postcode FROM supplier")
def postcode_extract(spark, sf):
    return M.table(spark, sf, "supplier").select("s_suppkey", P.postcode(F.concat(F.lit("12 High St, LS"), F.col("s_suppkey") % 9 + 1, F.lit(" 4AP, Leeds"))).alias("postcode"))


@Q.add("""SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN round(c_acctbal / 1000, 6) END AS lng, CASE WHEN c_custkey % 4 = 1 THEN 'LS1 4AP' END AS postal_code, CASE WHEN c_custkey % 4 = 2 THEN c_name END AS place_name FROM customer""")
def location_build(spark, sf):
    place = """CASE c_custkey % 4 WHEN 0 THEN concat('{"geo":{"latitude":"0","longitude":', c_acctbal / 1000, '},"name":"x"}') WHEN 1 THEN '[{"address":"12 High St, LS1 4AP"}]' WHEN 2 THEN concat('{"name":" ', c_name, ' "}') ELSE '["x"]' END"""
    rows = M.table(spark, sf, "customer").selectExpr("c_custkey", f"""'{{"location":' || {place} || '}}' AS j""")
    place = P.location(P.variant(F.col("j")))
    return rows.select("c_custkey", place["longitude"].alias("lng"), place["postal_code"].alias("postal_code"), place["place_name"].alias("place_name"))


@Q.add("""SELECT o_orderkey, CAST(o_orderkey AS BIGINT) AS n, round(o_totalprice, 2) AS price, strftime(o_orderdate, '%Y-%m-%d') AS day, CASE WHEN o_orderkey % 3 = 0 THEN 'true' WHEN o_orderkey % 3 = 1 THEN 'false' END AS flag, CAST(NULL AS VARCHAR) AS absent FROM orders""")
def type_coercion(spark, sf):
    rows = M.table(spark, sf, "orders").select("o_orderkey", F.col("o_orderkey").cast("string").alias("n"), F.round("o_totalprice", 2).cast("string").alias("price"), F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("day"), F.when(F.col("o_orderkey") % 3 == 0, " Yes").when(F.col("o_orderkey") % 3 == 1, "f").otherwise("maybe").alias("flag"), F.lit(1).alias("other"))
    out = schemas.coerce(rows, "o_orderkey bigint, n bigint, price double, day date, flag boolean, absent string")
    return out.withColumns({c: F.col(c).cast("string") for c in ("day", "flag")})


@Q.add("SELECT event_id, CASE event_type WHEN 'click' THEN 'true' WHEN 'view' THEN 'false' END AS flag FROM events")
def bool_truthiness(spark, sf):
    word = F.when(F.col("event_type") == "click", " T ").when(F.col("event_type") == "view", "NO").otherwise("on")
    return M.table(spark, sf, "events").select("event_id", schemas.truth(word).cast("string").alias("flag"))


@Q.add("SELECT event_id, CASE event_id % 3 WHEN 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') WHEN 1 THEN strftime(ts, '%Y-%m-%d 00:00:00') END AS at FROM events")
def timestamp_normalise(spark, sf):
    k = F.col("event_id") % 3
    text = F.when(k == 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")).when(k == 1, F.date_format("ts", "yyyy-MM-dd")).otherwise("T00:00:00")
    return M.table(spark, sf, "events").select("event_id", F.date_format(schemas.timestamp(text), "yyyy-MM-dd HH:mm:ss").alias("at"))


@Q.add("SELECT o_orderkey, strftime(o_orderdate, '%d.%m.%Y') AS shown FROM orders")
def display_dates(spark, sf):
    k = F.col("o_orderkey") % 3
    text = F.when(k == 0, F.date_format("o_orderdate", "yyyy-MM-dd")).when(k == 1, F.date_format("o_orderdate", "dd/MM/yyyy")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ssXXX"))
    return M.table(spark, sf, "orders").select("o_orderkey", X.display_date(text, "dd.MM.yyyy").alias("shown"))


@Q.add("SELECT event_id, CASE WHEN event_id % 2 = 0 THEN props ELSE '\"' || event_type || '\"' END AS j FROM events")
def json_coercion(spark, sf):
    text = F.when(F.col("event_id") % 2 == 0, F.col("props")).otherwise(F.col("event_type"))
    return M.table(spark, sf, "events").select("event_id", schemas.json_text(text).alias("j"))
