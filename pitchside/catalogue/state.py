"""Stored state: changelogs, upserts, fills, logs, latest rows, samples, streams."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from .. import store
from ..operators import latest, upsert
from ..streaming import state as S
from . import mapping as M

Q = M.Registry()
TS = "strftime({}, '%Y-%m-%d %H:%M:%S.%f') AS {}"


def text(c: str):
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(c)


@Q.add(f"""SELECT feed_id, afterTimestamp, afterId, afterChangeNumber FROM ({M.LOG})
    QUALIFY row_number() OVER (PARTITION BY feed_id ORDER BY ingestion_date DESC, afterChangeNumber DESC, afterTimestamp DESC, afterId DESC) = 1""")
def latest_cursor(spark, sf):
    return latest.latest_cursor(M.log(spark, sf))


@Q.add(f"""SELECT c.feed_id, afterTimestamp, afterId, afterChangeNumber FROM (SELECT CAST(c_custkey AS VARCHAR) AS feed_id FROM customer) c LEFT JOIN (SELECT * FROM ({M.LOG})
    QUALIFY row_number() OVER (PARTITION BY feed_id ORDER BY ingestion_date DESC, afterChangeNumber DESC, afterTimestamp DESC, afterId DESC) = 1) l USING (feed_id)""")
def cursor_per_feed(spark, sf):
    return latest.latest_cursor(M.log(spark, sf), M.table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("feed_id")))


@Q.add(f"SELECT feed_id, status FROM ({M.LOG}) QUALIFY row_number() OVER (PARTITION BY feed_id ORDER BY ingestion_date DESC, o_orderkey DESC) = 1")
def latest_status(spark, sf):
    return latest.latest_status(M.log(spark, sf), ("ingestion_date", "o_orderkey"))


EVENT_FEEDS = "SELECT CAST(user_id AS VARCHAR) AS id, ts AS last_access, event_id, event_type AS type, value FROM events"


@Q.add(f"SELECT id, {TS.format('last_access', 'last_access')}, event_id, type, value FROM ({EVENT_FEEDS}) QUALIFY row_number() OVER (PARTITION BY id ORDER BY last_access DESC, event_id DESC) = 1")
def feeds_metadata(spark, sf):
    rows = M.table(spark, sf, "events").selectExpr("cast(user_id AS string) AS id", "ts AS last_access", "event_id", "event_type AS type", "value")
    return latest.feeds_metadata(rows).select("id", text("last_access"), "event_id", "type", "value")


@Q.add(f"SELECT dataset_url, publisher_name, provider FROM ({M.FEEDS}) QUALIFY row_number() OVER (PARTITION BY dataset_url ORDER BY age DESC, id DESC) = 1")
def feeds_dedup(spark, sf):
    return latest.feeds_per_dataset(M.feeds(spark, sf).withColumnRenamed("age", "last_access"))


@Q.add(f"""WITH {M.O} SELECT dataset_url, feed_id, kind, id, l_partkey, round(l_extendedprice, 2) AS price FROM o
    QUALIFY row_number() OVER (PARTITION BY dataset_url, feed_id, kind ORDER BY id, l_partkey, l_extendedprice, l_quantity) <= 100""")
def stratified_sample(spark, sf):
    rows = latest.sample(M.plain(spark, sf), ["dataset_url", "feed_id", "kind"], 100, ["id", "l_partkey", "l_extendedprice", "l_quantity"])
    return rows.select("dataset_url", "feed_id", "kind", "id", "l_partkey", F.round("l_extendedprice", 2).alias("price"))


# which of a larger group's rows are chosen is up to a hash that the SQL does not have; groups of 500 or less are whole
@Q.add(f"""WITH {M.O} SELECT dataset_url, feed_id, kind, id FROM o QUALIFY row_number() OVER (PARTITION BY dataset_url, feed_id, kind ORDER BY id) <= 500""")
def hashed_sample(spark, sf):
    """At most 500 rows of each group, by a hash of the id."""
    return latest.sample(M.plain(spark, sf), ["dataset_url", "feed_id", "kind"], 500).select("dataset_url", "feed_id", "kind", "id")


ACTIVE = f"SELECT DISTINCT feed_id FROM ({M.LOG}) WHERE ingestion_date >= DATE '2001-07-01' - 30 AND (updated > 0 OR deleted > 0)"


def active(spark, sf):
    return latest.active_feeds(M.log(spark, sf), F.lit("2001-07-01").cast("date"))


@Q.add(ACTIVE)
def active_feeds(spark, sf):
    return active(spark, sf)


@Q.add(f"""WITH f AS ({M.FEEDS}), a AS ({ACTIVE}), j AS (SELECT f.*, a.feed_id IS NOT NULL AS is_active FROM f LEFT JOIN a USING (feed_id))
    SELECT feed_id, dataset_url FROM (SELECT *, max(is_active) OVER (PARTITION BY dataset_url) AS sibling FROM j) WHERE is_active OR NOT sibling OR dataset_url IS NULL""")
def stale_sibling_filter(spark, sf):
    return latest.without_stale(M.feeds(spark, sf), active(spark, sf)).select("feed_id", "dataset_url")


@Q.add("SELECT feed_id, id, seq, CAST(n AS BIGINT) AS n, state FROM (SELECT 'users' AS feed_id, CAST(user_id AS VARCHAR) AS id, event_id AS seq, json_extract_string(props, '$.k') AS n, CASE WHEN event_type = 'error' THEN 'deleted' ELSE 'updated' END AS state FROM events) WHERE state = 'updated'")
def flatten_changelog(spark, sf):
    rows = M.changes(spark, sf).select(F.lit("users").alias("feed_id"), F.col("user_id").cast("string").alias("id"), F.col("event_id").alias("seq"), F.try_variant_get(F.try_parse_json("props"), "$.k", "bigint").alias("n"), F.when(F.col("gone"), "deleted").otherwise("updated").alias("state"))
    return rows.where("state = 'updated'")


STATE = "SELECT user_id, event_id, event_type, value FROM (SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1) WHERE event_type <> 'error'"


@Q.add(STATE)
def latest_state(spark, sf):
    return S.latest_of_changelog(M.changes(spark, sf), ["user_id"], ["ts", "event_id"], F.col("gone")).select("user_id", "event_id", "event_type", "value")


OLD, NEW, GONE = "event_id % 2 = 0", "event_id % 2 = 1", "event_id % 74 = 1"
LAST = "SELECT user_id, event_id, event_type, value FROM (SELECT * FROM events WHERE {}) QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1"


def halves(spark, sf):
    rows = M.changes(spark, sf).withColumn("gone", F.expr(GONE)).select("user_id", "event_id", "event_type", "value", "gone")
    return upsert.keep_last(rows.where(OLD), ["user_id"], ["event_id"]).drop("gone"), rows.where(NEW)


@Q.add(f"""WITH a AS ({LAST.format(OLD)}), n AS (SELECT * FROM events WHERE {NEW}), g AS (SELECT DISTINCT user_id FROM n WHERE {GONE}),
    u AS (SELECT user_id, event_id, event_type, value FROM n WHERE NOT ({GONE}) QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1)
    SELECT * FROM a WHERE user_id NOT IN (SELECT user_id FROM u) AND user_id NOT IN (SELECT user_id FROM g) UNION ALL SELECT * FROM u""")
def upsert_merge(spark, sf):
    old, new = halves(spark, sf)
    return upsert.apply_changes(old, new, ["event_id"], F.col("gone"), ["user_id"])


@Q.add(f"WITH a AS ({LAST.format(OLD)}) SELECT * FROM a WHERE user_id NOT IN (SELECT user_id FROM events WHERE {NEW} AND {GONE})")
def delete_anti(spark, sf):
    old, new = halves(spark, sf)
    return upsert.delete(old, new.where("gone"), ["user_id"])


PARTS = "SELECT p_partkey, p_name, CASE WHEN p_size % 3 <> 0 THEN p_brand END AS p_brand, CASE WHEN p_size % 4 = 0 THEN ' ' WHEN p_size % 4 <> 1 THEN p_type END AS p_type, p_size FROM part"
GIVEN = "SELECT s_suppkey AS p_partkey, s_name AS p_brand, CASE WHEN s_suppkey % 2 = 0 THEN s_name END AS p_type FROM supplier"


def parts(spark, sf):
    for name in ("part", "supplier"):
        M.table(spark, sf, name).createOrReplaceTempView(name)
    return spark.sql(PARTS), spark.sql(GIVEN)


@Q.add(f"WITH t AS ({PARTS}), s AS ({GIVEN}) SELECT p_partkey, p_name, coalesce(t.p_brand, s.p_brand) AS p_brand, p_size FROM t LEFT JOIN s USING (p_partkey)")
def fill_if_null_merge(spark, sf):
    rows, given = parts(spark, sf)
    return upsert.fill(rows, given, ["p_partkey"], ["p_brand"], gate=F.col("p_brand").isNull()).drop("p_type")


@Q.add(f"WITH t AS ({PARTS}), s AS ({GIVEN}) SELECT p_partkey, CASE WHEN t.p_type IS NULL OR trim(t.p_type) = '' THEN coalesce(s.p_type, t.p_type) ELSE t.p_type END AS p_type, p_size FROM t LEFT JOIN s USING (p_partkey)")
def fill_if_empty_merge(spark, sf):
    rows, given = parts(spark, sf)
    return upsert.fill(rows, given, ["p_partkey"], ["p_type"], lambda c: c.isNull() | (F.trim(c) == "")).select("p_partkey", "p_type", "p_size")


@Q.add("SELECT c_custkey, c_name, coalesce(n_name, c_mktsegment) AS c_mktsegment FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_nationkey % 2 = 0) ON n_nationkey = c_nationkey")
def lookup_update(spark, sf):
    lookup = M.table(spark, sf, "nation").where("n_nationkey % 2 = 0").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("c_mktsegment"))
    return upsert.update_from(M.table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment"), lookup, ["c_nationkey"], ["c_mktsegment"]).drop("c_nationkey")


@Q.add("""WITH a AS (SELECT url, page_id, 0 AS n FROM pages WHERE page_id % 3 <> 0 UNION ALL SELECT url, page_id + 1000000, 1 FROM pages WHERE page_id % 3 <> 1)
    SELECT url, page_id FROM a QUALIFY row_number() OVER (PARTITION BY url ORDER BY n DESC, page_id DESC) = 1""")
def feeds_replace_dedup(spark, sf):
    pages = M.table(spark, sf, "pages").select("url", "page_id")
    return upsert.replace_dedup(pages.where("page_id % 3 <> 0"), pages.where("page_id % 3 <> 1").withColumn("page_id", F.col("page_id") + 1000000), ["url"], ["page_id"])


@Q.add("""SELECT l_orderkey, l_linenumber, l_partkey, round(l_extendedprice, 2) AS price FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey DESC, l_extendedprice DESC, l_suppkey DESC, l_quantity DESC) = 1""")
def composite_dedup(spark, sf):
    rows = M.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_suppkey", "l_quantity")
    last = upsert.keep_last(rows, ["l_orderkey", "l_linenumber"], ["l_partkey", "l_extendedprice", "l_suppkey", "l_quantity"])
    return last.select("l_orderkey", "l_linenumber", "l_partkey", F.round("l_extendedprice", 2).alias("price"))


@Q.add(f"""SELECT feed_id, {TS.format('ingestion_date', 'ingestion_date')}, CASE WHEN p THEN updated ELSE 0 END AS updated, CASE WHEN p THEN deleted ELSE 0 END AS deleted,
    CASE WHEN p THEN afterChangeNumber ELSE afterChangeNumber - 1 END AS afterChangeNumber, CASE WHEN p THEN status ELSE 'ERROR' END AS status FROM (SELECT *, o_orderkey % 5 <> 0 AS p FROM ({M.LOG}))""")
def ingestion_log(spark, sf):
    runs = M.log(spark, sf).selectExpr("*", "o_orderkey % 5 <> 0 AS persisted", "afterChangeNumber AS next_afterChangeNumber", "afterChangeNumber - 1 AS previous_afterChangeNumber", *(f"{c} AS {p}_{c}" for c in ("afterTimestamp", "afterId") for p in ("next", "previous")))
    return latest.ingestion_log(runs).select("feed_id", text("ingestion_date"), "updated", "deleted", "afterChangeNumber", "status")


@Q.add("SELECT strftime(max(o_orderdate), '%Y-%m-%d') AS ingestion_date FROM orders")
def max_ingestion_date(spark, sf):
    return latest.latest_ingestion(M.log(spark, sf)).select(F.col("ingestion_date").cast("string").alias("ingestion_date"))


@Q.add("SELECT o_orderkey FROM orders WHERE CAST(o_orderdate AS DATE) = (SELECT max(CAST(o_orderdate AS DATE)) FROM orders)")
def latest_day_feeds(spark, sf):
    return latest.latest_day(M.table(spark, sf, "orders").withColumnRenamed("o_orderdate", "last_access")).select("o_orderkey")


@Q.add(f"WITH {M.O} SELECT dataset_url, count(*) AS items, row_number() OVER (ORDER BY count(*) DESC, dataset_url) AS place FROM o WHERE l_partkey % 7 = 0 GROUP BY dataset_url")
def affected_datasets(spark, sf):
    rows = M.plain(spark, sf).where("l_partkey % 7 = 0").groupBy("dataset_url").agg(F.count("*").alias("items"))
    return rows.withColumn("place", F.row_number().over(Window.orderBy(F.col("items").desc(), "dataset_url")).cast("bigint"))


def stream(spark, sf):
    rows = M.table(spark, sf, "events")
    # a file source reads folders; one file is a folder's only file
    return spark.readStream.schema(rows.schema).option("pathGlobFilter", "events.parquet*").parquet(sf)


@Q.add(STATE)
def streaming_latest_state(spark, sf):
    at = store.folder(spark, "stream")
    state = S.StateTable(spark, f"{at}/state", "user_id bigint, ts timestamp, event_id bigint, event_type string, value double")
    rows = stream(spark, sf).select("user_id", "ts", "event_id", "event_type", "value")
    S.keep_state(rows, state, ["ts", "event_id"], F.col("event_type") == "error", ["user_id"], f"{at}/checkpoint").awaitTermination()
    return state.read().select("user_id", "event_id", "event_type", "value")


@Q.add("SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S.%f') AS window_start, event_type, count(*) AS events FROM events GROUP BY ALL")
def tumbling_window_counts(spark, sf):
    return S.tumbling_counts(M.table(spark, sf, "events"), "ts", ["event_type"]).select(text("window_start"), "event_type", "events")


@Q.add("""WITH a AS (SELECT *, CASE WHEN ts - lag(ts) OVER w < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS n FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
    b AS (SELECT *, sum(n) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS s FROM a)
    SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S.%f') AS session_start, strftime(max(ts) + INTERVAL 30 MINUTE, '%Y-%m-%d %H:%M:%S.%f') AS session_end, count(*) AS events FROM b GROUP BY user_id, s""")
def session_window_counts(spark, sf):
    return S.session_counts(M.table(spark, sf, "events"), "ts", ["user_id"]).select("user_id", text("session_start"), text("session_end"), "events")
