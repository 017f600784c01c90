from __future__ import annotations

import json
from urllib.parse import quote

import pytest
from hypothesis import given
from hypothesis import strategies as st

from pitchside.sources import rpde

PAGES = {
    "http://f/a": {"items": [{"id": 1, "state": "updated", "modified": "5", "data": {"x": 1}}], "next": "a2"},
    "http://f/a2": {"items": [{"id": 2, "state": "deleted", "modified": 6}], "next": "/a3"},
    "http://f/a3": {"items": [], "next": "http://f/a3"},
    "http://f/moved": {"items": [], "next": "http://f/a"},
    "http://f/loop": {"items": [{"id": 1}], "next": "http://f/loop"},
    "http://f/none": {"next": "x"},
    "http://f/half": {"items": [{"id": 9}], "next": "http://f/gone"},
}


@pytest.mark.parametrize(("url", "status", "n", "onward"), [("a", "COMPLETE", 2, "a3"), ("a3", "COMPLETE", 0, "a3"), ("moved", "WARNING", 0, "moved"), ("loop", "WARNING", 1, "loop"), ("none", "ERROR", 0, "none"), ("half", "ERROR", 1, "gone")])
def test_crawl(url, status, n, onward):
    out = rpde.crawl(f"http://f/{url}", PAGES.__getitem__)
    assert (out.status, len(out.items), out.next) == (status, n, f"http://f/{onward}")


def test_source(spark, tmp_path):
    for url, page in PAGES.items():
        (tmp_path / f"{quote(url, safe='')}.json").write_text(json.dumps(page))
    spark.dataSource.register(rpde.PagedFeed)
    urls = json.dumps({"one": "http://f/a", "two": "http://f/none"})
    rows = spark.read.format("paged_feed").option("urls", urls).option("folder", str(tmp_path)).load().orderBy("feed_id", "seq").collect()
    assert [(r.feed_id, r.id, r.state, r.modified, r.status, r.next) for r in rows] == [
        ("one", "1", "updated", 5, None, "http://f/a2"), ("one", "2", "deleted", 6, None, "http://f/a3"), ("one", None, None, None, "COMPLETE", "http://f/a3"), ("two", None, None, None, "ERROR", "http://f/none"),
    ]
    few = spark.read.format("paged_feed").option("urls", urls).option("folder", str(tmp_path)).option("mostPages", "1").load().where("feed_id = 'one'").orderBy("seq").collect()
    assert [(r.id, r.status, r.next) for r in few] == [("1", None, "http://f/a2"), (None, "COMPLETE", "http://f/a2")]


def test_pages_come_one_by_one_and_stop_in_time():
    asked = []
    feed = rpde.pages("http://f/a", lambda url: asked.append(url) or PAGES[url])
    assert [x["id"] for x in next(feed).items] == [1] and asked == ["http://f/a"]  # nothing is read ahead
    ticks = iter([0.0, 1.0, 700.0])
    out = list(rpde.pages("http://f/a", PAGES.__getitem__, most_seconds=600, clock=lambda: next(ticks)))
    assert [(len(x.items), x.status, x.next) for x in out] == [(1, None, "http://f/a2"), (0, "TIMEOUT", "http://f/a2")]


@pytest.mark.parametrize(("given", "joined", "spliced"), [("b?c=1", "http://h/x/b?c=1", "http://h/b?c=1"), ("/b", "http://h/b", "http://h/b"), ("?c=1", "http://h/x/a?c=1", "http://h?c=1"), ("https://g/y", "https://g/y", "https://g/y"), ("", "http://h/x/a", "http://h/x/a")])
def test_next_addresses(given, joined, spliced):
    assert (rpde.onward("http://h/x/a", given), rpde.onward("http://h/x/a", given, "http://h")) == (joined, spliced)


def test_get_asks_again(monkeypatch):
    import io
    import ssl
    import urllib.error

    said = []

    def answer(request, timeout, context):
        said.append(context is not None)
        if len(said) == 1:
            raise urllib.error.HTTPError(request.full_url, 503, "busy", {}, None)
        if context is None:
            raise urllib.error.URLError(ssl.SSLError("certificate"))
        return io.BytesIO(b'{"items": []}')

    monkeypatch.setattr(rpde.urllib.request, "urlopen", answer)
    assert rpde.get("https://f/a", sleep=lambda _: None, unverified=True) == {"items": []} and said == [False, False, True]
    with pytest.raises(urllib.error.URLError):
        rpde.get("https://f/a", sleep=lambda _: None)
    monkeypatch.setattr(rpde.urllib.request, "urlopen", lambda *a, **k: (_ for _ in ()).throw(urllib.error.HTTPError("https://f/a", 404, "gone", {}, None)))
    with pytest.raises(urllib.error.HTTPError):
        rpde.get("https://f/a", sleep=lambda _: None)


def test_stream_moves_a_page_at_a_time(tmp_path):
    for url, page in PAGES.items():
        (tmp_path / f"{quote(url, safe='')}.json").write_text(json.dumps(page))
    stream = rpde.FeedStream({"urls": json.dumps({"one": "http://f/a"}), "folder": str(tmp_path)})
    at, seen = stream.initialOffset(), []
    for _ in range(4):
        rows, end = stream.read(at)
        rows = list(rows)
        assert list(stream.readBetweenOffsets(at, end)) == rows  # a batch can be repeated
        seen += [r[4] for r in rows]
        at = end
    assert (seen, at) == (["1", "2"], {"one": "http://f/a3"})


@given(st.integers(0, 2**40), st.text("abc123", min_size=1), st.sampled_from(["http://h/x", "http://h/x?y=1"]))
def test_cursor_round_trip(number, word, url):
    assert rpde.cursor_of(rpde.start_url(url, number=number)) == (None, None, number)
    assert rpde.cursor_of(rpde.start_url(url, word, word)) == (word, word, None)


def test_table_pages(spark, tmp_path):
    for offset, page in ((0, {"features": [{"attributes": {"a": 1}}, {"attributes": {"a": 2}}], "exceededTransferLimit": True}), (2, {"features": [{"attributes": {"a": 3}}]})):
        (tmp_path / f"{quote(f'http://t/q?resultOffset={offset}', safe='')}.json").write_text(json.dumps(page))
    spark.dataSource.register(rpde.PagedTable)
    rows = spark.read.format("paged_table").option("url", "http://t/q").option("folder", str(tmp_path)).load().collect()
    assert [json.loads(r[0])["a"] for r in rows] == [1, 2, 3]


def test_geojson(spark, tmp_path):
    from pitchside.operators import spatial

    square = [[[0, 0], [2, 0], [2, 2], [0, 2], [0, 0]], [[0.5, 0.5], [1, 0.5], [1, 1], [0.5, 1], [0.5, 0.5]]]
    other = [[[[1, 1], [3, 1], [3, 3], [1, 3]]], [[[9, 9], [10, 9], [10, 10]]]]
    features = [{"type": "Feature", "properties": {"n": n, "c": n * 2}, "geometry": {"type": t, "coordinates": c}} for n, t, c in (("a", "Polygon", square), ("b", "MultiPolygon", other))]
    (tmp_path / "x.json").write_text(json.dumps({"type": "FeatureCollection", "features": features}))
    areas = spatial.read_geojson(spark, str(tmp_path / "x.json"), "n", "c")
    # inside, in the hole, on an edge, outside, in both, in the second part only
    points = spark.createDataFrame([(0.25, 0.25), (0.75, 0.75), (0.0, 1.0), (5.0, 5.0), (1.5, 1.5), (9.1, 9.5), (None, 1.0)], "lat double, lng double")
    got = {(r.lat, r.lng): (r.area, r.code) for r in spatial.point_in_polygon(points, areas, 0.3).collect()}
    assert got == {(0.25, 0.25): ("a", "aa"), (1.5, 1.5): ("a", "aa"), (9.1, 9.5): ("b", "bb")}


def test_saved_states(spark, tmp_path):
    from pitchside.sources import files

    (tmp_path / "feed-x-2026-01-02.json").write_text(json.dumps({"items": {"1": {"a": 1}}, "status": "COMPLETE", "next_url": "u"}))
    r = files.saved_states(spark, str(tmp_path)).first()
    assert (r.feed, str(r.day), r.status, r.id, json.loads(r["item"])) == ("feed-x", "2026-01-02", "COMPLETE", "1", {"a": 1})
