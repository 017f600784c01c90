"""Places, areas and dashboard figures: customers are points, literal polygons the areas."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import dashboard, districts, spatial
from . import mapping as M

Q = M.Registry()
# squares and a triangle over (lng, lat) = (account / 1000, key % 100 / 10); the first has a hole, the second overlaps it
POLYGONS = [
    ("A", 0, [[(0, 0), (4, 0), (4, 6), (0, 6)], [(1.03, 1.03), (2.03, 1.03), (2.03, 2.03), (1.03, 2.03)]]),
    ("B", 1, [[(3, 2), (8, 2), (8, 8), (3, 8)]]),
    ("C", 2, [[(-1, 0.05), (0, 9.95), (-2, 9.95)]]),
]
POINT = "SELECT c_custkey, c_nationkey, c_acctbal / 1000 AS lng, CAST(c_custkey % 100 AS DOUBLE) / 10 AS lat FROM customer"
AREA = f"""SELECT *, CASE WHEN lng > 0 AND lng < 4 AND lat > 0 AND lat < 6 AND NOT (lng >= 1.03 AND lng <= 2.03 AND lat >= 1.03 AND lat <= 2.03) THEN 'A'
    WHEN lng > 3 AND lng < 8 AND lat > 2 AND lat < 8 THEN 'B'
    WHEN lat > 0.05 AND lat < 9.95 AND lng > -1 - (lat - 0.05) / 9.9 AND lng < -1 + (lat - 0.05) / 9.9 THEN 'C' END AS area FROM ({POINT})"""


def polygons(spark):
    rows = [(a, o, [[{"lng": float(x), "lat": float(y)} for x, y in r] for r in rings]) for a, o, rings in POLYGONS]
    return spark.createDataFrame(rows, f"area string, ordinal int, rings {spatial.RINGS}")


def points(spark, sf):
    M.table(spark, sf, "customer").createOrReplaceTempView("customer")
    return spark.sql(POINT)


@Q.add(f"SELECT c_custkey, area FROM ({AREA})")
def boundary_lookup(spark, sf):
    rows = points(spark, sf)
    return rows.join(spatial.point_in_polygon(rows, polygons(spark), 0.5), ["lat", "lng"], "left").select("c_custkey", "area")


@Q.add(f"SELECT CAST(c_nationkey AS VARCHAR) AS feed_id, area AS value, count(*) AS cnt FROM ({AREA}) WHERE area IS NOT NULL GROUP BY ALL")
def geo_rollup(spark, sf):
    rows = points(spark, sf).groupBy(F.col("c_nationkey").cast("string").alias("feed_id"), "lat", "lng").agg(F.count("*").alias("cnt"))
    return spatial.geo_rollup(rows, polygons(spark), 0.5)


@Q.add(f"SELECT c_custkey, NOT (lat BETWEEN 5 AND 10 AND lng BETWEEN 0 AND 5) AND (lng BETWEEN 5 AND 10 AND lat BETWEEN 0 AND 5) AS swapped FROM ({POINT})")
def swapped_coordinates(spark, sf):
    return points(spark, sf).select("c_custkey", spatial.swapped(F.col("lat"), F.col("lng"), 5.0, 10.0, 0.0, 5.0).alias("swapped"))


@Q.add("""SELECT n_name AS district_name, CAST(n_nationkey + 100 * (n_nationkey % 2) AS VARCHAR) AS district_code, r_name AS region_name FROM nation JOIN region ON r_regionkey = n_regionkey""")
def district_build(spark, sf):
    nation = M.table(spark, sf, "nation").join(M.table(spark, sf, "region"), F.col("r_regionkey") == F.col("n_regionkey"))
    areas = nation.select(F.col("n_nationkey").cast("string").alias("district_code"), F.concat(F.lit(" "), F.lower("n_name")).alias("district_name"), F.col("r_name").alias("region_name"))
    own = nation.select(F.col("n_name").alias("district_name"), (F.col("n_nationkey") + 100 * (F.col("n_nationkey") % 2)).cast("string").alias("district_code"))  # odd ones are found by name
    return districts.build_districts(own, areas, ("region_name",))


@Q.add("""SELECT coalesce(a.k, b.k) AS district_code, coalesce(b.name, a.name) AS country_name, b.region AS region_name FROM (SELECT n_nationkey AS k, n_name AS name FROM nation WHERE n_nationkey % 3 <> 0) a
    FULL JOIN (SELECT n_nationkey AS k, CASE WHEN n_nationkey % 2 = 0 THEN upper(n_name) || '!' END AS name, r_name AS region FROM nation JOIN region ON r_regionkey = n_regionkey WHERE n_nationkey % 3 <> 1) b ON a.k = b.k""")
def ons_merge(spark, sf):
    nation, region = M.table(spark, sf, "nation"), M.table(spark, sf, "region")
    countries = nation.where("n_nationkey % 3 <> 0").select(F.col("n_nationkey").alias("district_code"), F.col("n_name").alias("country_name"))
    regions = nation.where("n_nationkey % 3 <> 1").join(region, F.col("r_regionkey") == F.col("n_regionkey")).select(F.col("n_nationkey").alias("district_code"), F.when(F.col("n_nationkey") % 2 == 0, F.concat(F.upper("n_name"), F.lit("!"))).alias("country_name"), F.col("r_name").alias("region_name"))
    return districts.merge_areas(countries, regions)


@Q.add("SELECT n_name AS name, count(c_custkey) AS count, CAST(n_nationkey * 1500 AS BIGINT) AS population, round(count(c_custkey) * 1000.0 / nullif(n_nationkey * 1500, 0), 2) AS rate FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY n_name, n_nationkey")
def population_rate(spark, sf):
    nation, customer = M.table(spark, sf, "nation"), M.table(spark, sf, "customer")
    counts = nation.join(customer, F.col("c_nationkey") == F.col("n_nationkey"), "left").groupBy(F.col("n_name").alias("name")).agg(F.count("c_custkey").alias("count"))
    people = nation.select(F.concat(F.lower("n_name"), F.lit(" ")).alias("name"), F.format_number(F.col("n_nationkey") * 1500, 0).alias("population"))
    return districts.population_rate(counts, people)


COUNTS = "SELECT n_name AS value, nullif(count(c_custkey), 55) AS count FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY n_name"


def area_counts(spark, sf):
    for name in ("nation", "customer"):
        M.table(spark, sf, name).createOrReplaceTempView(name)
    return spark.sql(COUNTS)


@Q.add(f"""WITH c AS ({COUNTS}), q AS (SELECT quantile_cont(count, 0.2) AS a, quantile_cont(count, 0.4) AS b, quantile_cont(count, 0.6) AS c, quantile_cont(count, 0.8) AS d FROM c)
    SELECT value, CAST(count AS DOUBLE) AS count, CASE WHEN count <= q.a THEN 'Very low' WHEN count <= q.b THEN 'Low' WHEN count <= q.c THEN 'Medium' WHEN count <= q.d THEN 'High' WHEN count IS NOT NULL THEN 'Very high' END AS bin FROM c, q""")
def quantile_bins(spark, sf):
    return dashboard.quantile_bins(area_counts(spark, sf)).withColumn("count", F.col("count").cast("double"))


@Q.add(f"SELECT count(*) AS areas, round(count(*) FILTER (count IS NULL OR count >= 60) * 100.0 / count(*), 4) AS shown_percent, round(count(*) FILTER (count >= 60) * 100.0 / count(*), 4) AS covered_percent FROM ({COUNTS})")
def coverage_kpi(spark, sf):
    return dashboard.coverage(area_counts(spark, sf), 60).withColumns({c: F.round(c, 4) for c in ("shown_percent", "covered_percent")})


@Q.add("SELECT p_name AS value, count(*) AS count FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY p_name ORDER BY count DESC, value LIMIT 20")
def top_n(spark, sf):
    part, items = M.table(spark, sf, "part"), M.table(spark, sf, "lineitem")
    return dashboard.top(items.join(part, F.col("p_partkey") == F.col("l_partkey")).groupBy(F.col("p_name").alias("value")).agg(F.count("*").alias("count")))


@Q.add(f"SELECT CASE coalesce(type, 'Event') WHEN 'Slot' THEN 'FacilityUse' ELSE coalesce(type, 'Event') END AS type, count(*) AS count, count(DISTINCT s_name) AS logos FROM ({M.FEEDS}) GROUP BY 1")
def feed_type_counts(spark, sf):
    return dashboard.feed_type_counts(M.feeds(spark, sf).withColumnRenamed("s_name", "logo_url"), {"Slot": "FacilityUse"})


@Q.add("SELECT c_custkey, c_name FROM customer WHERE lower(c_name) LIKE '%00001%' OR lower(c_mktsegment) LIKE '%00001%'")
def search(spark, sf):
    return dashboard.search(M.table(spark, sf, "customer"), "00001", "c_name", "c_mktsegment").select("c_custkey", "c_name")
