"""Partners, counters, cross-tabs and region figures: line items are sub-events, orders super-events."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from ..operators import partners
from . import mapping as M

Q = M.Registry()


# a second pair of feeds has the same ids
@Q.add("""SELECT 'a' AS pair, 'i' || l_orderkey || '-' || l_linenumber AS sub_id, CASE WHEN l_orderkey % 3 = 0 THEN NULL ELSE 'o/' || l_orderkey END AS super_id FROM lineitem""")
def partner_items(spark, sf):
    items, orders = M.table(spark, sf, "lineitem"), M.table(spark, sf, "orders")
    subs = items.select(F.lit("a").alias("pair"), F.concat(F.lit("i"), "l_orderkey", F.lit("-"), "l_linenumber").alias("id"), F.concat(F.lit("https://example.org/"), F.when(F.col("l_orderkey") % 3 == 0, "none").when(F.col("l_orderkey") % 3 == 1, "d").otherwise(""), F.col("l_orderkey").cast("string")).alias("super_ref"))
    supers = orders.select(F.lit("a").alias("pair"), F.concat(F.lit("o/"), "o_orderkey").alias("id"), F.concat(F.lit("x/d"), "o_orderkey").alias("data_id"), F.col("o_orderkey").alias("seq"))
    return partners.partner_items(subs, supers.unionByName(supers.withColumns({"pair": F.lit("b"), "seq": F.col("seq") + 10**9})))


URLS = "SELECT 'https://h' || (s_suppkey // 2) || '.org/' || CASE s_suppkey % 4 WHEN 0 THEN 'session-series' WHEN 1 THEN 'scheduled-sessions' WHEN 2 THEN 'facility-uses' ELSE 'facility-uses/events' END AS url FROM supplier"


@Q.add(f"SELECT u.url, v.url AS partner_url FROM ({URLS}) u JOIN ({URLS}) v ON split_part(u.url, '/', 3) = split_part(v.url, '/', 3) AND u.url <> v.url")
def partner_feeds(spark, sf):
    M.table(spark, sf, "supplier").createOrReplaceTempView("supplier")
    return partners.partner_feeds(spark.sql(URLS.replace("s_suppkey // 2", "s_suppkey div 2")))


@Q.add("SELECT event_type AS kind, count(*) AS count FROM (SELECT nullif(event_type, 'view') AS event_type FROM events) GROUP BY event_type")
def item_kinds(spark, sf):
    return partners.kind_counts(M.table(spark, sf, "events").select(F.nullif("event_type", F.lit("view")).alias("kind")), "kind")


_TYPE = "CASE WHEN l_suppkey % 5 = 0 AND l_partkey % 2 = 0 THEN NULL WHEN l_suppkey % 3 = 0 THEN 'SessionSeries' ELSE CASE WHEN l_suppkey % 5 = 0 THEN 'Slot' ELSE 'Event' END END"
_FEED = "CASE WHEN l_suppkey % 4 = 0 THEN 'league' ELSE 'unknown' END"


@Q.add(f"""WITH i AS (SELECT l_suppkey, {_TYPE} AS type, CASE WHEN l_partkey % 2 = 0 AND l_suppkey % 7 = 0 THEN 'Slot' WHEN l_suppkey % 2 = 0 THEN 'Slot' ELSE CASE WHEN l_partkey % 2 = 0 THEN 'x' ELSE 'Slot' END END AS kind, {_FEED} AS f FROM lineitem),
    e AS (SELECT l_suppkey, f, CASE type WHEN 'SessionSeries' THEN 'superevent' WHEN 'Slot' THEN 'subevent' WHEN 'Event' THEN 'subevent' END AS t, CASE kind WHEN 'Slot' THEN 'subevent' END AS k FROM i)
    SELECT l_suppkey AS feed_id, coalesce(CASE WHEN count(DISTINCT coalesce(t, '?')) = 1 THEN max(t) END, CASE WHEN count(DISTINCT coalesce(k, '?')) = 1 THEN max(k) END, CASE WHEN max(f) = 'league' THEN 'superevent' END) AS event_type FROM e GROUP BY l_suppkey""")
def event_type(spark, sf):
    M.table(spark, sf, "lineitem").createOrReplaceTempView("lineitem")
    kind = "CASE WHEN l_partkey % 2 = 0 AND l_suppkey % 7 = 0 THEN 'Slot' WHEN l_suppkey % 2 = 0 THEN 'Slot' ELSE CASE WHEN l_partkey % 2 = 0 THEN 'x' ELSE 'Slot' END END"
    items = spark.sql(f"SELECT l_suppkey AS feed_id, {_TYPE} AS type, {kind} AS kind FROM lineitem")
    feeds = spark.sql(f"SELECT DISTINCT l_suppkey AS feed_id, {_FEED} AS feed_type FROM lineitem")
    return partners.feed_event_type(items, feeds)


# items with up to three dates of their own sub-events; parts divisible by 13 are represented by partners
ITEM = f"SELECT l_suppkey AS feed_id, {M.KIND} AS kind, CASE WHEN l_partkey % 11 <> 0 THEN l_shipdate END AS startDate, l_linenumber % 4 AS n, l_shipdate, l_partkey, l_orderkey, l_linenumber FROM lineitem"
_OWN = "CASE WHEN n = 0 AND kind = 'Slot' AND startDate IS NOT NULL THEN 1 ELSE 0 END"


def _dates(cond: str) -> str:
    """How many dates of an item fulfil a condition on {d}."""
    subs = " + ".join(f"CASE WHEN n > {i} AND {cond.format(d=f'(l_shipdate + INTERVAL {3 * i} DAY)')} THEN 1 ELSE 0 END" for i in range(3))
    return f"({subs} + CASE WHEN {_OWN} = 1 AND {cond.format(d='l_shipdate')} THEN 1 ELSE 0 END)"


_ALL, _FUT, _WEEK = _dates("{d} IS NOT NULL"), _dates("{d} >= DATE '1998-06-15'"), _dates("{d} >= DATE '1998-06-15' AND {d} < DATE '1998-06-22'")
DATED = f"SELECT *, {_ALL} AS a, {_FUT} AS f, {_WEEK} AS w FROM ({ITEM})"


def items(spark, sf):
    M.table(spark, sf, "lineitem").createOrReplaceTempView("lineitem")
    rows = spark.sql(ITEM)
    return rows.withColumn("sub_dates", F.expr("CASE WHEN n = 0 THEN cast(array() AS array<timestamp>) ELSE transform(sequence(0, cast(n - 1 AS int)), i -> cast(l_shipdate + make_dt_interval(3 * i) AS timestamp)) END")).withColumn("represented", F.col("l_partkey") % 13 == 0)


@Q.add(f"""SELECT feed_id, count(*) AS num_analysis_items, count(*) FILTER (a > 0) AS num_opportunity_items, count(*) FILTER (f > 0) AS num_future_items, count(*) FILTER (w > 0) AS num_week_items,
    CAST(sum(a) AS BIGINT) AS num_start_dates, CAST(sum(f) AS BIGINT) AS num_future_dates, CAST(sum(w) AS BIGINT) AS num_week_dates FROM ({DATED}) WHERE l_partkey % 13 <> 0 GROUP BY feed_id""")
def feed_counters(spark, sf):
    return partners.feed_counters(items(spark, sf), date(1998, 6, 15))


@Q.add(f"SELECT kind, count(*) AS items, count(*) FILTER (a > 0) AS with_dates, count(*) FILTER (f > 0) AS with_future, count(*) FILTER (w > 0) AS with_week FROM ({DATED}) GROUP BY kind")
def presence_vectors(spark, sf):
    return partners.presence_vectors(partners.item_dates(partners.own_dates(items(spark, sf)), date(1998, 6, 15)), "kind")


CROSS = """SELECT n_name AS region, l_returnflag, l_linestatus, o_orderpriority, CASE WHEN l_linenumber % 5 <> 0 THEN o_orderstatus END AS o_orderstatus FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey"""


def crossed(spark, sf):
    for name in ("lineitem", "orders", "customer", "nation"):
        M.table(spark, sf, name).createOrReplaceTempView(name)
    return spark.sql(CROSS)


@Q.add(" UNION ALL ".join(f"SELECT region, '{d}' AS dimension, {d} AS value, count(*) AS count FROM ({CROSS}) WHERE {d} IS NOT NULL GROUP BY ALL" for d in ("l_returnflag", "l_linestatus", "o_orderpriority", "o_orderstatus")))
def cross_tab_region(spark, sf):
    return partners.cross_tab(crossed(spark, sf), "region", ("l_returnflag", "l_linestatus", "o_orderpriority", "o_orderstatus"))


@Q.add("SELECT l_returnflag, 'l_linestatus' AS dimension, l_linestatus AS value, count(*) AS count FROM lineitem GROUP BY ALL")
def cross_tab_kind_type(spark, sf):
    return partners.cross_tab(M.table(spark, sf, "lineitem"), "l_returnflag", ("l_linestatus",))


@Q.add(f"""SELECT l_orderkey, l_linenumber, l_partkey, concat_ws('_x_', coalesce(CASE WHEN l_partkey % 9 <> 0 THEN {M.KIND} END, 'None'), coalesce(o_orderstatus, 'None')) AS kind, coalesce(CASE WHEN l_partkey % 4 = 0 THEN l_linestatus END, o_orderpriority) AS scalar,
    CASE WHEN l_returnflag = o_orderstatus THEN l_returnflag WHEN l_returnflag < o_orderstatus THEN l_returnflag || ',' || o_orderstatus ELSE o_orderstatus || ',' || l_returnflag END AS "set"
    FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey""")
def partner_merge(spark, sf):
    rows = M.table(spark, sf, "lineitem").join(M.table(spark, sf, "orders"), F.col("o_orderkey") == F.col("l_orderkey"), "left")
    rows = rows.selectExpr("*", f"CASE WHEN l_partkey % 9 <> 0 THEN {M.KIND} END AS k", "CASE WHEN l_partkey % 4 = 0 THEN l_linestatus END AS s", "array(l_returnflag) AS a", "array(o_orderstatus) AS b")
    kind, scalar, both = partners.merge_partners({"kind": "k", "scalar": "s", "set": "a"}, {"kind": "o_orderstatus", "scalar": "o_orderpriority", "set": "b"})
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", kind, scalar, F.array_join(both, ",").alias("set"))


REGION = """SELECT c_custkey, CASE WHEN c_custkey % 6 = 0 THEN '_NO_LOCATION' WHEN c_custkey % 7 = 0 THEN '_UNMATCHED' ELSE r_name END AS region, c_mktsegment, n_name FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey"""


@Q.add(f"""SELECT region, count(*) AS items, count(DISTINCT c_mktsegment) AS organizers, count(DISTINCT n_name) AS activities, (SELECT string_agg(n_name || '=' || n, ',' ORDER BY n_name) FROM (SELECT n_name, count(*) AS n FROM ({REGION}) q WHERE q.region = r.region GROUP BY n_name)) AS activity_counts FROM ({REGION}) r GROUP BY region""")
def region_stats(spark, sf):
    for name in ("customer", "nation", "region"):
        M.table(spark, sf, name).createOrReplaceTempView(name)
    rows = spark.sql("SELECT CASE WHEN c_custkey % 6 <> 0 THEN 1.0D END AS lat, CASE WHEN c_custkey % 7 <> 0 THEN r_name END AS region, c_mktsegment AS organizer, array(n_name) AS activities FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey")
    return partners.region_stats(rows).withColumn("activity_counts", F.array_join(F.transform(F.array_sort(F.map_entries("activity_counts")), lambda e: F.concat_ws("=", e["key"], e["value"])), ","))


@Q.add("SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN p_name WHEN p_size % 3 = 0 THEN p_brand WHEN p_size % 5 = 0 THEN p_type WHEN p_size % 7 = 0 THEN 'f' ELSE 'Unknown' END AS activity FROM part")
def activity_fallback(spark, sf):
    pick = lambda n, c: F.when(F.col("p_size") % n == 0, F.array(c)).otherwise(F.array().cast("array<string>"))
    return M.table(spark, sf, "part").select("p_partkey", F.array_join(partners.activity_fallback(pick(2, "p_name"), pick(3, "p_brand"), pick(5, "p_type"), pick(7, F.lit("f"))), ",").alias("activity"))


@Q.add("SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_linenumber % 2 = 0 THEN l_returnflag ELSE c_name END AS provider FROM lineitem LEFT JOIN customer ON c_custkey = l_suppkey")
def facility_lookup(spark, sf):
    slots = M.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.concat(F.when(F.col("l_partkey") % 3 == 0, "a").when(F.col("l_partkey") % 3 == 1, "b").otherwise("c"), F.col("l_suppkey").cast("string")).alias("facility_ref"), F.when(F.col("l_linenumber") % 2 == 0, F.col("l_returnflag")).alias("provider"))
    facilities = M.table(spark, sf, "customer").select(F.col("c_custkey").alias("seq"), *(F.concat(F.lit(p), F.col("c_custkey").cast("string")).alias(c) for p, c in (("a", "id"), ("b", "data_id"), ("c", "alt_id"))), F.col("c_name").alias("provider"))
    return partners.facility_lookup(slots, facilities, ["provider"]).drop("facility_ref")


# customers are facilities at places by their key, with a segment as provider and a nation as activity
@Q.add("""WITH f AS (SELECT c_custkey AS seq, c_custkey % 50 AS place, c_mktsegment AS provider, c_nationkey AS activity, c_name AS name FROM customer),
    s AS (SELECT o_orderkey, o_custkey % 60 AS place, CASE WHEN o_orderkey % 2 = 0 THEN c_mktsegment ELSE 'none' END AS provider, CASE WHEN o_orderkey % 3 = 0 THEN c_nationkey ELSE -1 END AS activity FROM orders JOIN customer ON c_custkey = o_custkey)
    SELECT o_orderkey, coalesce(CASE WHEN o_orderkey % 5 = 0 THEN 'own' END, (SELECT arg_min(name, seq) FROM f WHERE f.place = s.place AND f.provider = s.provider AND f.activity = s.activity), (SELECT arg_min(name, seq) FROM f WHERE f.place = s.place AND f.provider = s.provider),
      (SELECT arg_min(name, seq) FROM f WHERE f.place = s.place AND f.activity = s.activity), (SELECT arg_min(name, seq) FROM f WHERE f.place = s.place)) AS name FROM s""")
def facility_by_place(spark, sf):
    customers, orders = M.table(spark, sf, "customer"), M.table(spark, sf, "orders")
    facilities = customers.select(F.col("c_custkey").alias("seq"), (F.col("c_custkey") % 50).cast("double").alias("lat"), F.lit(1.0).alias("lng"), F.col("c_mktsegment").alias("provider"), F.col("c_nationkey").cast("int").alias("activity"), F.col("c_name").alias("name"))
    k = F.col("o_orderkey")
    slots = orders.join(customers, F.col("c_custkey") == F.col("o_custkey")).select(
        "o_orderkey", (F.col("o_custkey") % 60).cast("double").alias("lat"), F.lit(1.0).alias("lng"), F.when(k % 2 == 0, F.col("c_mktsegment")).otherwise("none").alias("provider"), F.when(k % 3 == 0, F.col("c_nationkey").cast("int")).otherwise(-1).alias("activity"), F.when(k % 5 == 0, "own").alias("name"),
    )
    return partners.facility_by_place(slots, facilities, ["name"]).select("o_orderkey", "name")


@Q.add("SELECT l_orderkey, l_linenumber, l_partkey, coalesce(CASE WHEN l_partkey % 2 = 0 THEN l_returnflag END, o_orderpriority) AS organizer, o_orderstatus AS super_super FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey")
def legacy_inherit(spark, sf):
    from ..operators.upsert import fill

    rows = M.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.when(F.col("l_partkey") % 2 == 0, F.col("l_returnflag")).alias("organizer"), F.lit(None).cast("string").alias("super_super"))
    given = M.table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderpriority").alias("organizer"), F.col("o_orderstatus").alias("super_super"))
    return fill(rows, given, ["l_orderkey"], ["organizer", "super_super"])


@Q.add("SELECT feed_url, CASE WHEN bool_or(run = 'F') THEN 'y' ELSE '' END AS F, CASE WHEN bool_or(run = 'O') THEN 'y' ELSE '' END AS O, CASE WHEN bool_or(run = 'P') THEN 'y' ELSE '' END AS P FROM (SELECT CAST(o_custkey AS VARCHAR) AS feed_url, o_orderstatus AS run FROM orders) GROUP BY feed_url")
def feed_history_matrix(spark, sf):
    return partners.history_matrix(M.table(spark, sf, "orders").select(F.col("o_custkey").cast("string").alias("feed_url"), F.col("o_orderstatus").alias("run")), ("F", "O", "P"))


@Q.add(f"""SELECT count(DISTINCT publisher_name) AS publishers_all, count(DISTINCT dataset_url) AS datasets_all, count(*) AS feeds_all, count(DISTINCT publisher_name) FILTER (is_regular) AS publishers_regular, count(DISTINCT dataset_url) FILTER (is_regular) AS datasets_regular,
    count(*) FILTER (is_regular) AS feeds_regular, count(DISTINCT publisher_name) FILTER (NOT is_regular) AS publishers_preview, count(DISTINCT dataset_url) FILTER (NOT is_regular) AS datasets_preview, count(*) FILTER (NOT is_regular) AS feeds_preview FROM ({M.FEEDS})""")
def scope_figures(spark, sf):
    return partners.scope_figures(M.feeds(spark, sf))


@Q.add("SELECT p_partkey, CASE WHEN p_size % 2 = 0 AND p_size % 3 = 0 THEN p_size || '-' || (p_size + 9) WHEN p_size % 2 = 0 THEN p_size || '+' WHEN p_size % 3 = 0 THEN '0-' || (p_size + 9) ELSE 'Unknown' END AS ages FROM part")
def age_labels(spark, sf):
    s = F.col("p_size")
    return M.table(spark, sf, "part").select("p_partkey", partners.age_label(F.when(s % 2 == 0, s), F.when(s % 3 == 0, s + 9)).alias("ages"))


@Q.add(f"""WITH {M.O} SELECT id, array_to_string(list_transform(list_filter(range(0, l_linenumber % 4), lambda i: (l_partkey + i) % 3 <> 0), lambda i: '" ' || c_name || ' "'), ',') AS names FROM o""")
def recursive_get_values(spark, sf):
    """Names of organizers anywhere in payloads, by the search in document order."""
    rows = M.opportunities(spark, sf).select("id", "has_subEvent")
    return rows.select("id", F.array_join(partners.get_values(F.col("has_subEvent"), ["organizer", "provider"], ["name"]), ",").alias("names"))
