from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from pitchside import schemas
from pitchside.functions import payload as P
from pitchside.functions import text as X
from pitchside.operators import partners


def one(spark, payload, *columns):
    df = spark.createDataFrame([(json.dumps(payload) if not isinstance(payload, str) else payload,)], "j string").withColumn("v", P.variant(F.col("j")))
    return df.select(*columns).first()


@pytest.mark.parametrize(
    ("given", "want"),
    [({"prefLabel": "Yoga"}, ["Yoga"]), ("Yoga", ["Yoga"]), ([{"prefLabel": "Yoga"}, "Run", {"id": 1}, ""], ["Yoga", "Run"]), ([], []), (None, []), (5, [])],
)
def test_activities(spark, given, want):
    assert one(spark, {"activity": given}, P.activities(F.col("v")))[0] == want


def test_facilities_take_the_first_that_is_given(spark):
    assert one(spark, {"facilityType": [], "facilities": None, "category": "Pool"}, P.facilities(F.col("v")))[0] == ["Pool"]


@pytest.mark.parametrize(("given", "want"), [("x", None), ({"prefLabel": " A "}, ["A"]), ([{"prefLabel": ""}], None)])
def test_accessibility(spark, given, want):
    assert one(spark, {"accessibilitySupport": given}, P.accessibility(F.col("v")))[0] == want


@pytest.mark.parametrize(("organizer", "want"), [("", "P"), ("https://x", None), ({"name": " O "}, "O"), ([{"name": ""}, {"name": "L"}], "L")])
def test_organization_name(spark, organizer, want):
    assert one(spark, {"organizer": organizer, "provider": {"name": " P "}}, P.organization_name(F.col("v")))[0] == want


def test_schedule_dates(spark):
    given = {"startDate": "2026-01-01", "eventSchedule": [{"startDate": "2026-03-02", "endDate": "2026-04-01"}, {"startDate": "2026-03-01T10:00:00Z"}]}
    start, end = P.dates(F.col("v"))
    r = one(spark, given, F.date_format(start, "yyyy-MM-dd HH:mm"), F.date_format(end, "yyyy-MM-dd HH:mm"))
    assert tuple(r) == ("2026-03-01 10:00", "2026-04-01 00:00")


@pytest.mark.parametrize(("text", "want"), [("2026-01-01", "2026-01-01 00:00"), ("2026-01-01T10:00:00+01:00", "2026-01-01 09:00"), ("T00:00:00", None), ("", None), ("2026", None)])
def test_timestamps(spark, text, want):
    assert one(spark, json.dumps(text), F.date_format(schemas.timestamp(P.scalar(F.col("v"))), "yyyy-MM-dd HH:mm"))[0] == want


def test_location(spark):
    r = one(spark, {"location": {"geo": {"latitude": "0", "longitude": -1.23456789}, "address": "a"}}, P.location(F.col("v")))[0]
    assert (r.latitude, r.longitude, r.address) == (None, -1.234568, None)
    r = one(spark, {"location": {"address": "12 High St, LS1 4AP"}}, P.location(F.col("v")))[0]
    assert (r.address, r.postal_code) == ("12 High St, LS1 4AP", "LS1 4AP")
    assert one(spark, {"location": {"name": " Hall "}}, P.location(F.col("v")))[0].place_name == "Hall"
    inner = {"location": {"containsPlace": {"geo": {"latitude": 1, "longitude": 2}}}}
    assert one(spark, inner, P.location(F.col("v")))[0].latitude is None
    assert one(spark, inner, P.location(F.col("v"), True))[0].latitude == 1


def test_three_kinds_of_nothing(spark):
    given = {"a": None, "b": {}, "c": 0, "d": False, "e": ""}
    has = [P.present(P.at(F.col("v"), f"$.{k}")) for k in "abcdex"]
    assert list(one(spark, given, *has)) == [False, False, True, True, False, False] or [bool(x) for x in one(spark, given, *has)] == [False, False, True, True, False, False]
    assert one(spark, given, P.keys(F.col("v")))[0] == list("abcde")
    assert one(spark, {"a": {"b": 1}}, P.scalar(F.col("v"), "$.a"))[0] is None


def test_feed_names_and_ids(spark):
    df = spark.createDataFrame([("FacilityUse Slots",), ("Scheduled Sessions",), ("sessions",), ("Foo",)], "n string")
    assert [r[0] for r in df.select(X.feed_type(F.col("n"))).collect()] == ["Slot", "ScheduledSession", "SessionSeries", ""]
    r = one(spark, '"x"', X.feed_id(F.lit("https://www.a.co.uk/x/y/")), X.provider(F.lit("https://www.a.co.uk/x/y/")), X.spec_url(F.lit("http://WWW.A.org/b")))
    assert tuple(r) == ("a-co-uk-x-y", "a.co.uk", "https://a.org/b/")


@pytest.mark.parametrize(
    ("payload", "want"),
    [({"a": {"organizer": {"name": "N"}}}, ["N"]), ([{"organizer": {"name": "A"}}, {"organizer": {"name": "B"}}], ["A", "B"]), ({"organizer": {"x": {"name": "N"}}}, []), ({"z": {"organizer": {"name": "1"}}, "b": {"organizer": {"name": "2"}}}, ["1"])],
)
def test_get_values(spark, payload, want):
    df = spark.createDataFrame([(json.dumps(payload),)], "j string")
    assert [json.loads(x) for x in df.select(partners.get_values(F.col("j"), ["organizer"], ["name"])).first()[0]] == want


def test_coercion(spark):
    df = spark.createDataFrame([("yes", "7.9", "2026-01-02T03:04:05Z", "x")], "a string, b string, c string, d string")
    r = schemas.coerce(df, "a boolean, b bigint, c date, d double, e string").first()
    assert (r.a, r.b, str(r.c), r.d, r.e) == (True, 7, "2026-01-02", None, None)
    assert one(spark, '"x"', schemas.json_text(F.lit("plain text")), schemas.json_text(F.lit('{"a":1}')), schemas.json_text(F.lit(" "))) == ('"plain text"', '{"a":1}', None)
