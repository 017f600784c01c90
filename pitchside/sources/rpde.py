"""Feeds of cursor-paged JSON as a batch and streaming source.

    spark.dataSource.register(PagedFeed)
    spark.read.format("paged_feed").option("urls", json.dumps({feed_id: url})).load()

Each feed is one partition, and its rows are given page by page, so no task holds a feed. A page is {"items": [...], "next": url}; an empty
page that names itself is the end. The last row of a feed has no item but its status and the address to go on from; the rows before have the address after
their page, so that what was written of a long feed says where to go on. Options: `mostPages`, `mostSeconds` (then the status is TIMEOUT), `splice` (`origin`: a next
address without a host is put after the first page's origin, as older feeds mean it), `unverified` (hosts with bad certificates are asked again without a check).
`fetch` is how a page is got: http(s), or a folder of saved pages through any file system that pyarrow knows.
"""

from __future__ import annotations

import json
import random
import ssl
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import partial
from urllib.parse import parse_qs, quote, unquote, urljoin, urlsplit

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition, SimpleDataSourceStreamReader

SCHEMA = "feed_id string, seq bigint, state string, kind string, id string, modified bigint, data string, status string, next string"
RETRY = (403, 429, 500, 502, 503, 504)


def get(url: str, tries: int = 3, timeout: float = 30, sleep: Callable[[float], None] = time.sleep, unverified: bool = False) -> dict:
    """The page at an address. Busy servers and broken bodies are tried again, after longer and longer whiles. unverified: where the certificate
    does not hold, without a check of it."""
    context = None
    k = 0
    while k < tries:
        try:
            with urllib.request.urlopen(urllib.request.Request(url, headers={"Accept": "application/json"}), timeout=timeout, context=context) as r:  # noqa: S310
                return json.loads(r.read())
        except urllib.error.HTTPError as e:
            if e.code not in RETRY or k + 1 == tries:
                raise
        except (urllib.error.URLError, ValueError, TimeoutError) as e:
            if unverified and context is None and isinstance(getattr(e, "reason", None), ssl.SSLError):
                context = ssl._create_unverified_context()  # noqa: S323, SLF001
                continue
            if k + 1 == tries:
                raise
        sleep(2**k + random.random())  # noqa: S311
        k += 1
    raise ValueError("tries must be positive")


def saved(folder: str, url: str) -> dict:
    """A page from a folder in which files are named by the quoted address."""
    from pyarrow import fs

    at, path = fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), folder)
    with at.open_input_file(f"{path}/{quote(url, safe='')}.json") as f:
        return json.loads(f.read())


def cursor_of(url: str) -> tuple[str | None, str | None, int | None]:
    query = parse_qs(urlsplit(url).query)
    first = lambda name: (query.get(name) or [None])[0]
    number = first("afterChangeNumber")
    return first("afterTimestamp"), first("afterId"), int(number) if number and number.lstrip("-").isdigit() else None


def start_url(url: str, timestamp: str | None = None, id_: str | None = None, number: int | None = None) -> str:
    join = "&" if "?" in url else "?"
    if number is not None:
        return f"{url}{join}afterChangeNumber={number}"
    if timestamp is not None and id_ is not None:
        return f"{url}{join}afterTimestamp={timestamp}&afterId={id_}"
    return url


def onward(at: str, given: str, origin: str | None = None) -> str:
    """The next page's address. origin: what an address without a host is put after, be it relative or not."""
    parts = urlsplit(unquote(given))
    if origin is None or parts.scheme and parts.netloc or not (parts.path or parts.query):
        return urljoin(at, given)
    path = parts.path if not parts.path or parts.path.startswith("/") else f"/{parts.path}"
    return f"{origin}{path}{'?' + parts.query if parts.query else ''}"


def is_last(page: dict, url: str) -> bool:
    return not page.get("items") and urljoin(url, str(page.get("next") or "")) == url


@dataclass
class Crawl:
    items: list[dict] = field(default_factory=list)
    status: str | None = "COMPLETE"
    next: str = ""
    pages: int = 0


def pages(url: str, fetch: Callable[[str], dict] = get, most_pages: int | None = None, most_seconds: float | None = None, splice: bool = False, clock: Callable[[], float] = time.monotonic) -> Iterator[Crawl]:
    """Each page's items with the address to go on from; the last one has a status. What was read before an error stays. An empty page
    that leads elsewhere, and a page with items that leads to itself, end it with a warning."""
    at, n, began = url, 0, clock()
    origin = "{0.scheme}://{0.netloc}".format(urlsplit(url)) if splice else None
    while True:
        if most_pages is not None and n >= most_pages:
            yield Crawl([], "COMPLETE", at, n)
            return
        if most_seconds is not None and clock() - began >= most_seconds:
            yield Crawl([], "TIMEOUT", at, n)
            return
        try:
            page = fetch(at)
            items = page["items"]
            if not isinstance(items, list):
                raise TypeError("items is no list")
        except Exception:  # noqa: BLE001  whatever a server sends ends this feed only
            yield Crawl([], "ERROR", at, n)
            return
        n += 1
        following = onward(at, str(page.get("next") or ""), origin)
        own = [x for x in items if isinstance(x, dict)]
        if following == at or not items:
            yield Crawl(own, "COMPLETE" if following == at and not items else "WARNING", at, n)
            return
        at = following
        yield Crawl(own, None, at, n)


def crawl(url: str, fetch: Callable[[str], dict] = get, most_pages: int | None = None, **options) -> Crawl:
    """All of it at once, for short feeds and tests."""
    out = Crawl(next=url)
    for page in pages(url, fetch, most_pages, **options):
        out = Crawl(out.items + page.items, page.status, page.next, page.pages)
    return out


def row(feed: str, seq: int, item: dict, status: str | None, following: str) -> tuple:
    data = item.get("data")
    modified = item.get("modified")
    modified = int(modified) if isinstance(modified, int) or isinstance(modified, str) and modified.lstrip("-").isdigit() else None
    text = lambda k: None if item.get(k) is None else str(item[k])
    return feed, seq, text("state"), text("kind"), text("id"), modified, None if data is None else json.dumps(data), status, following


@dataclass
class Feed(InputPartition):
    feed: str
    url: str


def fetcher(options: dict) -> Callable[[str], dict]:
    folder = options.get("folder")
    if folder:
        return lambda url: saved(folder, url)
    return partial(get, unverified=str(options.get("unverified", "")).lower() == "true")


class PagedFeed(DataSource):
    @classmethod
    def name(cls) -> str:
        return "paged_feed"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> FeedReader:
        return FeedReader(dict(self.options))

    def simpleStreamReader(self, schema) -> FeedStream:  # noqa: N802
        return FeedStream(dict(self.options))


class FeedReader(DataSourceReader):
    """A partition per feed, read page by page; its last row has only its status and next address."""

    def __init__(self, options: dict):
        self.options = options

    def partitions(self) -> list[Feed]:
        return [Feed(k, v) for k, v in sorted(json.loads(self.options["urls"]).items())]

    def read(self, partition: Feed) -> Iterator[tuple]:
        given = {k.lower(): v for k, v in self.options.items()}
        most, seconds = given.get("mostpages"), given.get("mostseconds")
        seq = 0
        for page in pages(partition.url, fetcher(given), int(most) if most else None, float(seconds) if seconds else None, given.get("splice") == "origin"):
            for item in page.items:
                yield row(partition.feed, seq, item, None, page.next)
                seq += 1
            if page.status is not None:
                yield partition.feed, seq, None, None, None, None, None, page.status, page.next


class FeedStream(SimpleDataSourceStreamReader):
    """The offset is each feed's next address; a batch is a page of each."""

    def __init__(self, options: dict):
        self.options, self.urls = options, json.loads(options["urls"])

    def initialOffset(self) -> dict:  # noqa: N802
        return dict(self.urls)

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        rows, end = [], {}
        for feed, url in sorted(start.items()):
            out = crawl(url, fetcher(self.options), 1)
            rows += [row(feed, k, x, out.status, out.next) for k, x in enumerate(out.items)]
            end[feed] = out.next
        return iter(rows), end

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:  # noqa: N802
        return self.read(start)[0]


class PagedTable(DataSource):
    """Tables served by resultOffset pages: {"features": [{"attributes": {...}}], "exceededTransferLimit": bool}."""

    @classmethod
    def name(cls) -> str:
        return "paged_table"

    def schema(self) -> str:
        return "attributes string"

    def reader(self, schema) -> TableReader:
        return TableReader(dict(self.options))


class TableReader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = options

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        url, offset, fetch = self.options["url"], 0, fetcher(self.options)
        while True:
            page = fetch(f"{url}{'&' if '?' in url else '?'}resultOffset={offset}")
            rows = page.get("features", [])
            for x in rows:
                yield (json.dumps(x.get("attributes", {})),)
            offset += len(rows)
            if not rows or not page.get("exceededTransferLimit"):
                return
