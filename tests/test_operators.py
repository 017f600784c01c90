from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from pitchside import specs
from pitchside.operators import dashboard, field_usage, insights, latest, quality, upsert
from pitchside.plans import ingest
from pitchside.schemas import OPPORTUNITIES
from pitchside.streaming import state as S


def table(spark, rows, ddl):
    return spark.createDataFrame(rows, ddl)


def test_a_key_deleted_and_updated_in_one_batch_stays(spark):
    old = table(spark, [(1, "a"), (2, "b")], "k int, v string")
    new = table(spark, [(1, "x", 0, False), (1, None, 1, True), (2, None, 2, True), (3, "n", 3, False), (3, "m", 4, False)], "k int, v string, seq int, gone boolean")
    get = lambda strict: sorted(map(tuple, upsert.apply_changes(old, new, ["seq"], F.col("gone"), ["k"], strict).collect()))
    assert get(False) == [(1, "x"), (3, "m")]
    assert get(True) == [(3, "m")]


def test_upserts_repeat_without_effect(spark):
    old = table(spark, [(1, "a"), (2, "b")], "k int, v string")
    new = table(spark, [(2, "x"), (3, "y")], "k int, v string")
    once = upsert.upsert(old, new, ["k"])
    assert sorted(map(tuple, upsert.upsert(once, new, ["k"]).collect())) == sorted(map(tuple, once.collect())) == [(1, "a"), (2, "x"), (3, "y")]


def test_fills_never_overwrite(spark):
    rows = table(spark, [(1, "a"), (2, None), (3, None)], "k int, v string")
    given = table(spark, [(1, "x"), (2, "y")], "k int, v string")
    assert sorted(map(tuple, upsert.fill(rows, given, ["k"], ["v"]).collect())) == [(1, "a"), (2, "y"), (3, None)]


@pytest.mark.parametrize(("args", "want"), [((151, 40, 40, 5, 0, False, "OK"), "Gold"), ((150, 40, 40, 5, 0, False, "OK"), "Silver"), ((151, 24, 40, 5, 0, False, "OK"), "Bronze"), ((151, 40, 40, 5, 0, False, "WARNING"), None), ((0, 40, 40, 5, 0, False, "OK"), None)])
def test_grades(spark, args, want):
    n, a, b, c, d, missing, status = args
    lit = [F.lit(float(x)) for x in (a, b, c, d)]
    assert spark.range(1).select(quality.grade(F.lit(status), F.lit(n), *lit, F.lit(missing))).first()[0] == want


def test_statuses(spark):
    rows = [("ERROR", "ok", "", None, 5, "Slot"), ("COMPLETE", None, None, None, 0, "Slot"), ("COMPLETE", None, None, None, 0, "FacilityUse"), ("WARNING", "http_error", "HTTP 500", None, 0, "Slot"), ("COMPLETE", "empty", "Feed has no items", "Slot: a", 0, "Slot")]
    got = quality.classify(table(spark, rows, "ingestion_status string, probe_kind string, probe_message string, missing_text string, num_future int, feed_type string")).collect()
    assert [(r.status, r.errors, r.warnings) for r in got] == [
        ("ERROR", ["Data parsing error (invalid JSON or missing 'items')"], []),
        ("WARNING", [], ["No future opportunities scheduled"]),
        ("OK", [], []),
        ("ERROR", ["HTTP 500"], []),
        ("WARNING", [], ["Missing required fields — Slot: a", "Feed has no items"]),
    ]


def test_spec_bounds():
    assert [specs.bounds("Event", v) for v in ("V1.0", "V1.1", "V2.0", "V2.1")] == [(-21, 46), (-21, 46), (-30, 59), (-30, 60)]
    assert (specs.bounds("FacilityUse", "V2.0"), specs.bounds("Slot", "V2.1"), specs.bounds("RouteGuide", "V1.0")) == ((-24, 37), (-18, 23), (-33, 59))
    assert (specs.resolve_version(["V1.0", "V2.0"], "V1.5"), specs.resolve_version(["V2.0"], "V1.0")) == ("V1.0", "V2.0")


def test_versions_by_distinguishing_properties(spark):
    def detect(*payloads):
        rows = [("d", "f", "Event", k, json.dumps(p)) for k, p in enumerate(payloads)]
        items = quality.item_categories(table(spark, rows, "dataset_url string, feed_id string, feed_type string, seq int, json_data string"))
        r = quality.detect_versions(items, quality.version_scores(items)).first()
        return r.category, r.version, r.score is None

    old = {"@id": 1, "url": 1, "name": 1, "location": 1, "activity": 1}
    assert detect(old) == ("Event", "V1.1", False)
    assert detect(old | {"offers": 1})[1] == "V2.0"
    assert detect(old | {"routeGuide": 1})[1] == "V2.1"
    assert detect({"x": 1}) == ("Event", "V0.x", True)
    assert detect({"@type": "Slot"}, {"@type": "Slot"}, {"type": "Event"})[0] == "Slot"


def test_walker(spark):
    payload = {"@type": "Event", "organizer": {"@type": ["Organization"], "name": 1}, "location": {"name": "x"}, "superEvent": "uri", "sub": [{"type": "Place", "geo": None}]}
    assert sorted(field_usage.entities(payload, "kind")) == [("Event", ["organizer", "location", "superEvent", "sub"]), ("Organization", ["name"]), ("Place", ["geo"])]
    assert list(field_usage.entities({"a": 1}, "Kind")) == [("Kind", ["a"])]
    assert list(field_usage.entities("x", "Kind")) == []
    got = spark.range(1).select(*(field_usage.usage_class(F.lit(n), F.lit(p)) for n, p in ((0, 0.0), (9, 0.9), (50, 5.0), (100, 10.0)))).first()
    assert list(got) == ["UNUSED", "RARE", "LOW", "COMMON"]


def test_stale_siblings(spark):
    feeds = table(spark, [("a", "1"), ("b", "1"), ("c", "2"), ("d", "2"), ("e", None)], "feed_id string, dataset_url string")
    kept = latest.without_stale(feeds, table(spark, [("a",)], "feed_id string"))
    assert sorted(r.feed_id for r in kept.collect()) == ["a", "c", "d", "e"]


def test_scopes_and_shares(spark):
    feeds = table(spark, [("a", True), ("b", False), ("c", None)], "feed_id string, is_regular boolean")
    counts = table(spark, [(f, "k", v, 2) for f in "abc" for v in "xy"], "feed_id string, category string, value string, cnt bigint")
    got = insights.category_rollup(counts, feeds).collect()
    total = {s: sum(r["count"] for r in got if r.scope == s) for s in insights.SCOPES}
    assert total == {"all": 12, "regular": 4, "preview": 4}
    assert all(abs(sum(r.percentage for r in got if r.scope == s) - 100) < 1e-9 for s in insights.SCOPES)


def test_bins_without_areas(spark):
    assert dashboard.quantile_bins(table(spark, [], "value string, count bigint")).count() == 0


def test_ingest_from_items_to_table(spark):
    series = {"@id": "https://a/1", "@type": "SessionSeries", "name": "s", "location": {"geo": {"latitude": 1, "longitude": 2}}, "activity": [{"prefLabel": "Yoga"}], "organizer": {"name": "O"}}
    session = {"@id": "https://a/2", "@type": "ScheduledSession", "superEvent": "https://a/1", "startDate": "2026-01-01T10:00:00Z"}
    facility = {"@id": "https://a/3", "@type": "FacilityUse", "name": "F", "location": {"geo": {"latitude": 3, "longitude": 4}}, "individualFacilityUse": [{"@id": "https://a/3#1", "name": "I"}]}
    slot = {"@id": "https://a/4", "@type": "Slot", "facilityUse": "https://a/3#1"}
    items = [("f", k, "updated", str(k), k, json.dumps(p)) for k, p in enumerate((series, session, facility, slot))] + [("f", 9, "deleted", "old", 9, None)]
    items = table(spark, items, "feed_id string, seq bigint, state string, id string, modified bigint, data string")
    feeds = table(spark, [("f", "d", "p")], "id string, dataset_url string, publisher_name string")
    stored = spark.createDataFrame([], OPPORTUNITIES).unionByName(table(spark, [("d", "f", "old"), ("d", "f", "kept")], "dataset_url string, feed_id string, id string"), allowMissingColumns=True)
    square = table(spark, [("North", "N1", 0, [[{"lng": 0.0, "lat": 0.0}, {"lng": 9.0, "lat": 0.0}, {"lng": 9.0, "lat": 9.0}, {"lng": 0.0, "lat": 9.0}]])], "area string, code string, ordinal int, rings array<array<struct<lng:double,lat:double>>>")
    got = {r.id: r for r in ingest.ingest(stored, items, feeds, {"district": square}).collect()}
    assert sorted(got) == ["0", "1", "2", "3", "kept"]
    assert got["1"].activity == ["Yoga"] and got["1"].organization_name == "O" and got["1"].district_name == "North"
    assert json.loads(got["1"].location)["latitude"] == 1.0 and str(got["1"].startDate) == "2026-01-01 10:00:00"
    assert json.loads(got["3"].location)["latitude"] == 3.0 and got["3"].district_code == "N1"


def test_stream_state_repeats_batches(spark, tmp_path):
    ddl = "k int, seq int, v string, gone boolean"
    folder = tmp_path / "in"
    state = S.StateTable(spark, f"file://{tmp_path}/state", "k int, seq int, v string")
    for rows in ([(1, 0, "a", False), (2, 1, "b", False)], [(1, 2, "c", False), (2, 3, None, True)]):
        table(spark, rows, ddl).coalesce(1).write.mode("append").parquet(str(folder))
        stream = spark.readStream.schema(ddl).parquet(str(folder))
        S.keep_state(stream, state, ["seq"], F.col("gone"), ["k"], f"file://{tmp_path}/checkpoint").awaitTermination()
    assert list(map(tuple, state.read().collect())) == [(1, 2, "c")]
    assert state.newest() == 1


def test_sessions(spark):
    at = dt.datetime(2026, 1, 1)
    rows = [(1, at + dt.timedelta(minutes=m)) for m in (0, 10, 50, 100)]
    got = S.session_counts(table(spark, rows, "u int, ts timestamp"), "ts", ["u"]).orderBy("session_start").collect()
    assert [r.events for r in got] == [2, 1, 1]


def test_field_usage_run(spark):
    from pitchside.config import EngineConfig
    from pitchside.plans import field_usage as plan

    rows = [("d", "f", str(k), "Event", json.dumps({"name": 1, "extra": 1} if k else {"name": 1, "place": {"@type": "Odd", "x": 1}})) for k in range(4)]
    rows = table(spark, rows, "dataset_url string, feed_id string, id string, kind string, json_data string")
    model = table(spark, [("Event", "name", "required"), ("Event", "url", "required")], "category string, field string, model_status string")
    feeds = table(spark, [("d", "P")], "dataset_url string, publisher_name string")
    got = plan.run(rows, feeds, model, {"Event": "Event"}, {}, EngineConfig(dt.date(2026, 1, 1)))
    assert {(r.field, r.presence_pct, r.classification) for r in got.model.collect()} == {("name", 100.0, "COMMON"), ("url", 0.0, "UNUSED")}
    assert {(r.field, r.presence_pct) for r in got.extensions.collect()} == {("extra", 75.0), ("place", 25.0)}
    assert [(r.type, r.field) for r in got.discovered.collect()] == [("Odd", "x")]
    assert {(r.type, r.publisher_name, tuple(r.absent or ())) for r in got.datasets.collect()} == {("Event", "P", ("url",)), ("Odd", "P", ())}
    assert "| url | required | 0 | 0.0 | UNUSED |" in got.report()


def test_only_named_parents_are_read(spark, tmp_path):
    from pitchside.operators import inherit

    ddl = "dataset_url string, feed_id string, id string, data_id string, kind string, has_superEvent string, has_subEvent string, json_data string"
    stored = [("a", "f", "1", "p1", "SessionSeries", None, None, None), ("a", "f", "2", "p2", "SessionSeries", None, None, None), ("a", "f", "3", "u", "FacilityUse", None, None, '{"individualFacilityUse":[{"@id":"n1"}]}')]
    stored += [(d, "f", f"{d}{k}", f"p{k}", "SessionSeries", None, None, None) for d in "bc" for k in range(50)] + [("b", "f", "u", "u", "FacilityUse", None, None, None)]
    table(spark, stored, ddl).write.parquet(f"{tmp_path}/stored")
    held = spark.read.parquet(f"{tmp_path}/stored")
    batch = table(spark, [("a", "f", "9", "s", "Slot", '"n1"', None, None), ("a", "f", "8", "e", "Event", "p1", None, None), ("b", "f", "7", "e", "Slot", '"p3"', None, None), ("b", "f", "6", "g", "Event", '{"@id":"p4"}', None, None)], ddl)
    named = inherit.named_parents(batch, held)
    assert sorted((r.dataset_url, r.data_id) for r in named.collect()) == [("a", "p1"), ("a", "u"), ("b", "p3")]
    plan = named._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and plan.count("LeftSemi") >= 2


def test_places_of_nested_uses_have_their_own_areas(spark):
    facility = {"@id": "f", "@type": "FacilityUse", "location": {"geo": {"latitude": 3, "longitude": 4}}, "individualFacilityUse": [{"@id": "f#1", "location": {"geo": {"latitude": 13, "longitude": 4}}}]}
    slots = [{"@id": "s1", "@type": "Slot", "facilityUse": "f#1"}, {"@id": "s2", "@type": "Slot", "facilityUse": {"@id": "f", "location": {"geo": {"latitude": 23, "longitude": 4}}}}, {"@id": "s3", "@type": "Slot", "facilityUse": "f", "location": {}}]
    items = table(spark, [("f", k, "updated", str(k), k, json.dumps(p)) for k, p in enumerate((facility, *slots))], "feed_id string, seq bigint, state string, id string, modified bigint, data string")
    feeds = table(spark, [("f", "d", "p")], "id string, dataset_url string, publisher_name string")
    box = lambda y: [[{"lng": 0.0, "lat": y}, {"lng": 9.0, "lat": y}, {"lng": 9.0, "lat": y + 9}, {"lng": 0.0, "lat": y + 9}]]
    squares = table(spark, [(f"D{k}", f"C{k}", k, box(10.0 * k)) for k in range(3)], "area string, code string, ordinal int, rings array<array<struct<lng:double,lat:double>>>")
    codes = table(spark, [("D1", "R1")], "district_name string, region_name string")
    got = {r.data_id: r for r in ingest.ingest(spark.createDataFrame([], OPPORTUNITIES), items, feeds, {"district": squares}, districts=codes, keep_inherited=True).collect()}
    assert [got[k].district_name for k in ("f", "s1", "s2", "s3")] == ["D0", "D1", "D2", "D0"] and got["s1"].region_name == "R1" and got["f"].region_name is None
    assert got["s3"].location is None  # the payload has the key
    assert json.loads(got["s2"].inherited_data).keys() == {"location"}
    assert json.loads(got["s3"].inherited_data).keys() == {"individualFacilityUse"} and got["f"].inherited_data is None


def test_written_tables_are_in_the_default_file_system(spark, tmp_path):
    from pitchside import store

    assert store.qualified(spark, "/a/b") == "file:/a/b" and store.qualified(spark, f"file://{tmp_path}/x").startswith("file:/")
    conf = spark._jsc.hadoopConfiguration()
    before = conf.get("fs.defaultFS")
    conf.set("fs.defaultFS", "viewfs://cluster/")
    conf.set("fs.viewfs.mounttable.cluster.link./checkpoints", f"file://{tmp_path}")
    try:
        assert store.qualified(spark, "/checkpoints/a") == "viewfs://cluster/checkpoints/a"
    finally:
        conf.set("fs.defaultFS", before)
