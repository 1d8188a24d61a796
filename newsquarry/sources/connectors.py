"""Search connectors as Spark data sources.

A connector is a class with ``name`` and ``pages(query, after, before)`` that
yields pages of items, newest first.  Network access, keys and request signing
belong to the connector that a user registers; the replay connector here reads
recorded pages, for tests and for repeating a run.
"""

from __future__ import annotations

import hashlib
import hmac
import html
import json
import os
import re
import urllib.parse
from collections.abc import Iterator
from datetime import UTC, datetime
from email.utils import parsedate_to_datetime
from xml.etree import ElementTree

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

ITEM = "url string, title string, description string, published_at string, source string, ts long"


class RateLimited(Exception):
    """The service asks to come later."""


class BackendError(Exception):
    """The service refused or failed."""


def check_status(status: int) -> None:
    """Raises for statuses that mean later (429, 502, 503, 504) or never (other errors)."""
    if status in (429, 502, 503, 504):
        raise RateLimited(str(status))
    if status >= 400:
        raise BackendError(str(status))


def signature(params: dict, allowed: set[str], secret: bytes) -> str:
    """HMAC-SHA256 over the allowed parameters in order; the secret comes from configuration."""
    text = urllib.parse.urlencode(sorted((k, v) for k, v in params.items() if k in allowed))
    return hmac.new(secret, text.encode(), hashlib.sha256).hexdigest()


def feed_time(text: str) -> tuple[str, int | None]:
    """(ISO date, seconds since the epoch) of a mail-style date; the first ten characters and None for what is none."""
    try:
        at = parsedate_to_datetime(text)
    except (ValueError, TypeError):
        return text[:10], None
    at = at if at.tzinfo else at.replace(tzinfo=UTC)
    return at.date().isoformat(), int(at.timestamp())


def parse_feed(xml: str) -> list[dict]:
    """Items of an RSS document with a title and a link; [] for what is no XML."""
    try:
        root = ElementTree.fromstring(xml)
    except ElementTree.ParseError:
        return []
    out = []
    for item in root.iter("item"):
        get = lambda tag, item=item: (item.findtext(tag) or "").strip()
        if get("title") and get("link"):
            at = feed_time(get("pubDate"))
            text = " ".join(html.unescape(re.sub(r"<[^>]*>", " ", get("description"))).split())
            out.append({"url": get("link"), "title": get("title"), "description": text, "published_at": at[0], "source": get("source"), "ts": at[1]})
    return out


def windowed(pages: Iterator[list[dict]], after: str, before: str, max_pages: int = 200) -> Iterator[dict]:
    """Items of the window, each URL once, from pages that come newest first.

    Items without a time are kept.  Paging ends at an empty page, a page without a new
    URL, or one whose oldest known time lies before the window.
    """
    day = lambda s: datetime.fromisoformat(s).replace(tzinfo=UTC).timestamp()
    low, high = day(after), day(before) + 86_400
    seen: set[str] = set()
    for n, page in enumerate(pages):
        if n >= max_pages or not page:
            return
        fresh = [x for x in page if x["url"] not in seen]
        if not fresh:
            return
        for x in fresh:
            if x["url"] not in seen:
                seen.add(x["url"])
                if x.get("ts") is None or low <= x["ts"] <= high:
                    yield x
        times = [x["ts"] for x in page if x.get("ts") is not None]
        if times and min(times) < low:
            return


class ReplayPartition(InputPartition):
    def __init__(self, folder: str):
        super().__init__(folder)


class ReplaySource(DataSource):
    """``spark.read.format("news_replay").option("path", ...).option("after", ...).option("before", ...)``.

    Each sub-folder of ``path`` is one recorded query with files page-0001.json and so on; each is a partition.
    """

    @classmethod
    def name(cls) -> str:
        return "news_replay"

    def schema(self) -> str:
        return ITEM

    def reader(self, schema) -> ReplayReader:
        return ReplayReader(self.options)


class ReplayReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.after, self.before = options["path"], options.get("after", "0001-01-02"), options.get("before", "9998-12-30")

    def partitions(self):
        return [ReplayPartition(os.path.join(self.path, d)) for d in sorted(os.listdir(self.path)) if os.path.isdir(os.path.join(self.path, d))]

    def read(self, partition):
        def pages():
            for name in sorted(os.listdir(partition.value)):
                with open(os.path.join(partition.value, name), encoding="utf-8") as f:
                    yield json.load(f)

        for x in windowed(pages(), self.after, self.before):
            yield (x["url"], x.get("title"), x.get("description"), x.get("published_at"), x.get("source"), x.get("ts"))


class FeedSource(DataSource):
    """``spark.read.format("news_feed").option("path", ...)``: recorded RSS documents.

    With ``after`` and ``before`` only items of these days, or of unknown time, are given.
    """

    @classmethod
    def name(cls) -> str:
        return "news_feed"

    def schema(self) -> str:
        return ITEM

    def reader(self, schema) -> FeedReader:
        return FeedReader(self.options)


class FeedPartition(InputPartition):
    def __init__(self, files: list[str]):
        super().__init__(files)


class FeedReader(DataSourceReader):
    #: Documents are spread over at most so many tasks.
    PARTITIONS = 64

    def __init__(self, options: dict):
        self.path, self.after, self.before = options["path"].removeprefix("file:"), options.get("after", "0001-01-02"), options.get("before", "9998-12-30")

    def partitions(self):
        files = [os.path.join(self.path, f) for f in sorted(os.listdir(self.path)) if not f.startswith((".", "_"))]
        return [FeedPartition(files[i :: self.PARTITIONS]) for i in range(min(self.PARTITIONS, len(files)))]

    def read(self, partition):
        for name in partition.value:
            with open(name, encoding="utf-8") as f:
                items = parse_feed(f.read())
            for x in windowed(iter([items]), self.after, self.before):
                yield (x["url"], x["title"], x["description"], x["published_at"], x["source"], x["ts"])
