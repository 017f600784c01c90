"""Schemas of the stored tables, and the coercion of rows to them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# fixed values: the tables' columns
OPPORTUNITIES = """dataset_url string, feed_id string, id string, data_id string, kind string, modified bigint,
    json_data string, inherited_data string, location string, ageRange string, level string, has_superEvent string,
    has_subEvent string, organization_json string, activity array<string>, facility array<string>,
    accessibilitySupport array<string>, district_name string, district_code string, region_name string,
    region_code string, country_name string, country_code string, nhstrust_name string, nhstrust_code string,
    publisher_name string, organization_name string, genderRestriction string, startDate timestamp, endDate timestamp,
    last_updated date"""
FEEDS = """id string, url string, type string, dataset_name string, dataset_url string, provider string,
    license_url string, logo_url string, publisher_name string, rpde_version string, model_version string,
    is_regular boolean, last_access date"""
FEED_INGESTION = """ingestion_date timestamp, number_of_catalogues int, number_of_datasets int, number_of_feeds int,
    catalogues array<string>, datasets array<string>, feed_ids array<string>"""
INGESTION_LOG = """dataset_id string, feed_id string, kind string, ingestion_date timestamp, updated bigint,
    deleted bigint, afterTimestamp string, afterId string, afterChangeNumber bigint, status string"""
KEYS = ("dataset_url", "feed_id", "id")
# columns that a child takes from its parent where its own are empty
INHERITED = (
    "location", "activity", "facility", "accessibilitySupport", "ageRange", "level", "genderRestriction", "startDate",
    "endDate", "organization_name", "district_name", "district_code", "region_name", "region_code", "country_name",
    "country_code", "nhstrust_name", "nhstrust_code",
)
TRUE_WORDS, FALSE_WORDS = ("1", "true", "t", "yes", "y"), ("0", "false", "f", "no", "n")


def struct(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


def truth(c: Column) -> Column:
    """A boolean from words; any other word is null."""
    word = F.lower(F.trim(c.cast("string")))
    return F.when(word.isin(*TRUE_WORDS), True).when(word.isin(*FALSE_WORDS), False)


def json_text(c: Column) -> Column:
    """Valid JSON stays as it is; any other text becomes a JSON string."""
    return F.when(c.isNull() | (F.trim(c) == ""), F.lit(None)).when(F.try_parse_json(c).isNotNull(), c).otherwise(F.to_json(F.to_variant_object(F.array(c))).substr(F.lit(2), F.length(F.to_json(F.to_variant_object(F.array(c)))) - 2))


def timestamp(c: Column) -> Column:
    """An ISO date or date-time text as a UTC timestamp; what has no date in front is null."""
    text = F.trim(c.cast("string"))
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}"), text.try_cast("timestamp"))


def coerced(c: Column, given: T.DataType, want: T.DataType) -> Column:
    if given == want:
        return c
    if isinstance(want, T.BooleanType):
        return truth(c)
    if isinstance(want, T.TimestampType):
        return c.cast(want) if isinstance(given, T.DateType) else timestamp(c)
    if isinstance(want, T.DateType):
        return c.cast(want) if isinstance(given, T.TimestampType) else timestamp(c).cast("date")
    if isinstance(want, T.IntegralType):
        return F.floor(c.try_cast("double")).try_cast(want) if isinstance(given, T.StringType) else c.try_cast(want)
    if isinstance(want, T.StringType) and isinstance(given, (T.ArrayType, T.StructType, T.MapType)):
        return F.to_json(c)
    return c.try_cast(want)


def coerce(df: DataFrame, want: T.StructType | str) -> DataFrame:
    """The columns of `want`, each cast where it can be; missing columns and bad values are null, others go."""
    want = struct(want) if isinstance(want, str) else want
    have = {f.name: f.dataType for f in df.schema}
    return df.select(*((coerced(F.col(f"`{f.name}`"), have[f.name], f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name) for f in want))


def ensure_table(spark: SparkSession, name: str, ddl: str, partition: str | None = None) -> None:
    """Creates the table if there is none."""
    by = f" PARTITIONED BY ({partition})" if partition else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl}) USING parquet{by}")
