"""The driver's tables as the domain's: line items are opportunities, suppliers feeds, nations datasets, orders log rows
and parents, customers places, events a changelog. The SQL below says the same on plain columns."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

REF = date(1998, 6, 15)


class Registry:
    def __init__(self) -> None:
        self.queries: dict[str, Callable] = {}
        self.sql: dict[str, str] = {}

    def add(self, sql: str | None = None, name: str | None = None) -> Callable:
        def keep(f: Callable) -> Callable:
            key = name or f.__name__
            self.queries[key] = f
            if sql:
                self.sql[key] = sql
            return f

        return keep


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


KIND = "CASE l_returnflag WHEN 'R' THEN 'Slot' WHEN 'A' THEN 'FacilityUse' ELSE 'SessionSeries' END"

# what both engines read: opportunities on plain columns
PLAIN = f"""
    SELECT CAST(s_nationkey AS STRING) AS dataset_url, CAST(l_suppkey AS STRING) AS feed_id,
           concat(CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING)) AS id, {KIND} AS kind, l_partkey AS modified,
           CASE WHEN l_partkey % 11 <> 0 THEN l_shipdate END AS start_date, l_shipdate, l_partkey, l_linenumber, l_orderkey, l_quantity, l_extendedprice,
           p_name, p_type, p_brand, c_name, CAST(c_custkey % 100 AS DOUBLE) / 10 AS lat, c_acctbal / 1000 AS lng, c_custkey, c_mktsegment, o_orderdate
    FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN part ON p_partkey = l_partkey
         JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey"""

# for the SQL twins; the inline sub-events that are objects
O = f"o AS ({PLAIN.replace('STRING', 'VARCHAR')})"
SUB = """sub AS (SELECT o.*, i, CASE WHEN (l_partkey + i) % 5 = 0 THEN date_trunc('day', l_shipdate) ELSE l_shipdate END + to_days(CAST(i AS INTEGER)) AS sub_start
                 FROM (SELECT *, unnest(range(0, l_linenumber % 4)) AS i FROM o) AS o WHERE (l_partkey + i) % 3 <> 0)"""


def plain(spark: SparkSession, sf: str) -> DataFrame:
    for name in ("lineitem", "supplier", "part", "orders", "customer"):
        table(spark, sf, name).createOrReplaceTempView(name)
    return spark.sql(PLAIN)


def opportunities(spark: SparkSession, sf: str) -> DataFrame:
    """With payloads as JSON texts, next to the plain columns."""
    element = """transform(sequence(0, cast(l_linenumber % 4 - 1 as int)), i -> CASE WHEN (l_partkey + i) % 3 = 0 THEN concat('"https://example.org/e/', i, '"') ELSE concat('{',
        CASE WHEN i % 2 = 0 THEN '"@type":"ScheduledSession","activity":[{"prefLabel":' ELSE '"type":"Event","activity":{"prefLabel":' END, to_json(array(p_name)), '}', CASE WHEN i % 2 = 0 THEN ']' ELSE '' END,
        CASE WHEN (l_partkey + i) % 7 = 0 THEN ',"dateStart":"' ELSE ',"startDate":"' END,
        CASE WHEN (l_partkey + i) % 5 = 0 THEN date_format(l_shipdate + make_dt_interval(i), 'yyyy-MM-dd') ELSE date_format(l_shipdate + make_dt_interval(i), "yyyy-MM-dd'T'HH:mm:ss'Z'") END,
        '","facilityType":[{"prefLabel":"', p_type, '"}],"organizer":{"name":" ', c_name, ' "},"accessibilitySupport":{"prefLabel":"', p_brand,
        '"},"location":{"geo":{"latitude":', lat, ',"longitude":"', lng, '"}}}') END)""".replace("to_json(array(p_name))", "concat('\"', p_name, '\"')")
    organizer = "CASE WHEN l_partkey % 5 <> 0 THEN named_struct('name', concat(' ', c_name, ' ')) END"
    access = "CASE WHEN l_partkey % 4 = 0 THEN array(named_struct('prefLabel', p_brand)) END"
    return plain(spark, sf).selectExpr(
        "*",
        "start_date AS startDate",
        f"CASE WHEN l_linenumber % 4 > 0 THEN concat('[', array_join({element}, ','), ']') END AS has_subEvent",
        "CASE WHEN kind = 'SessionSeries' THEN array(p_name) END AS activity",
        "CASE WHEN kind <> 'SessionSeries' THEN array(p_type) END AS facility",
        f"to_json(named_struct('@type', kind, 'name', p_name, 'organizer', {organizer}, 'accessibilitySupport', {access})) AS json_data",
        "to_json(named_struct('organizer', named_struct('name', upper(c_mktsegment)), 'accessibilitySupport', array(named_struct('prefLabel', 'inherited')))) AS inherited_data",
        "CASE WHEN l_partkey % 7 <> 0 THEN to_json(named_struct('latitude', lat, 'longitude', lng)) END AS location",
    )


def feeds(spark: SparkSession, sf: str) -> DataFrame:
    for name in ("supplier", "nation", "region"):
        table(spark, sf, name).createOrReplaceTempView(name)
    return spark.sql(FEEDS.replace("VARCHAR", "STRING"))


FEEDS = """
    SELECT CAST(s_suppkey AS VARCHAR) AS feed_id, CAST(s_suppkey AS VARCHAR) AS id, CAST(s_nationkey AS VARCHAR) AS dataset_url, n_name AS publisher_name, r_name AS provider,
           CASE WHEN s_suppkey % 17 <> 0 THEN s_acctbal >= 0 END AS is_regular, CASE s_suppkey % 4 WHEN 0 THEN 'Slot' WHEN 1 THEN 'FacilityUse' WHEN 2 THEN 'SessionSeries' END AS type,
           s_name, CAST(CAST(s_acctbal AS INTEGER) % 30 AS INTEGER) AS age
    FROM supplier JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey"""

# orders as the ingestion log
LOG = """
    SELECT CAST(o_custkey AS VARCHAR) AS feed_id, o_orderdate AS ingestion_date, CASE o_orderstatus WHEN 'F' THEN 'COMPLETE' WHEN 'P' THEN 'WARNING' ELSE 'ERROR' END AS status,
           CAST(floor(o_totalprice) AS BIGINT) % 7 AS updated, CAST(floor(o_totalprice) AS BIGINT) % 3 AS deleted, o_orderkey AS afterChangeNumber, o_orderpriority AS afterTimestamp,
           CAST(o_orderkey AS VARCHAR) AS afterId, o_orderkey
    FROM orders"""


def log(spark: SparkSession, sf: str) -> DataFrame:
    table(spark, sf, "orders").createOrReplaceTempView("orders")
    return spark.sql(LOG.replace("VARCHAR", "STRING"))


def changes(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select("user_id", "ts", "event_id", "event_type", "value", "props", (F.col("event_type") == "error").alias("gone"))
