"""Lookups of administrative areas."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def merge_areas(countries: DataFrame, regions: DataFrame, key: str = "district_code") -> DataFrame:
    """Both lists in one: a region's values go over a country's."""
    over = regions.select(F.col(key).alias("_k"), *(F.col(c).alias(f"_r_{c}") for c in regions.columns if c != key))
    both = countries.join(over, F.col(key) == F.col("_k"), "full_outer")
    names = list(dict.fromkeys([*countries.columns, *regions.columns]))
    pick = lambda c: F.coalesce(*[F.col(x) for x in ((["_k"] if c == key else [f"_r_{c}"] if c in regions.columns else []) + ([c] if c in countries.columns else []))]).alias(c)
    return both.select(*(pick(c) for c in names))


def build_districts(districts: DataFrame, areas: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """District names with their areas: by code, else by name. areas: district_code, district_name and the columns."""
    by_code = areas.select("district_code", *(F.col(c).alias(f"_c_{c}") for c in columns)).dropDuplicates(["district_code"])
    by_name = areas.groupBy(F.lower(F.trim("district_name")).alias("_name")).agg(*(F.min(c).alias(f"_n_{c}") for c in columns))
    both = districts.join(by_code, "district_code", "left").join(by_name, F.lower(F.trim("district_name")) == F.col("_name"), "left")
    return both.select("district_name", "district_code", *(F.coalesce(f"_c_{c}", f"_n_{c}").alias(c) for c in columns))


def population_rate(counts: DataFrame, population: DataFrame, per: int = 1000) -> DataFrame:
    """Counts per so many people; names are compared without case. population: name, population (text, maybe with commas)."""
    people = population.select(F.lower(F.trim("name")).alias("_name"), F.regexp_replace(F.col("population").cast("string"), ",", "").try_cast("bigint").alias("population"))
    both = counts.join(people, F.lower(F.trim("name")) == F.col("_name"), "left").drop("_name")
    return both.withColumn("rate", F.round(F.try_divide(F.col("count") * per, F.col("population")), 2))
