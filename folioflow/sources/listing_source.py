"""A paginated listing as a Spark data source (Python Data Source API).

The transport is a port: a callable from URL to text, given by import path, so that tests and batch jobs use stored pages
and a crawler may use HTTP.  Each start page is a partition; a reader follows next links, waits between requests,
notices loops and stalls, and stops at the listing's own total."""

from __future__ import annotations

import time
from importlib import import_module

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from .html_pages import NEXT_TEXTS, _Page


class ListingSource(DataSource):
    """Options: starts (comma-separated), transport (module:function), delay_seconds, max_pages."""

    @classmethod
    def name(cls) -> str:
        return "listing"

    def schema(self) -> str:
        return "start string, page int, position int, href string, text string, problem string"

    def reader(self, schema) -> DataSourceReader:
        return _Reader(dict(self.options))


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = options

    def partitions(self):
        return [InputPartition(x) for x in self.options["starts"].split(",") if x]

    def read(self, partition):
        module, function = self.options["transport"].split(":")
        fetch = getattr(import_module(module), function)
        delay, most = float(self.options.get("delay_seconds", 1.25)), int(self.options.get("max_pages", 10_000))
        url, page, seen = partition.value, 0, set()
        while url:
            if url in seen or page >= most:
                yield (partition.value, page, None, url, None, "loop" if url in seen else "too_many_pages")
                return
            if page:
                time.sleep(delay)
            seen.add(url)
            try:
                html = fetch(url)
            except Exception as error:  # noqa: BLE001  errors are rows; other partitions go on
                yield (partition.value, page, None, url, None, f"fetch: {type(error).__name__}")
                return
            p = _Page()
            p.feed(html)
            p.close()
            p.close_anchor()
            onward = None
            for a in p.anchors:
                if "next" in a["rel"].split() or a["text"].lower() in NEXT_TEXTS:
                    onward = onward or a["href"]
                else:
                    yield (partition.value, page, a["pos"], a["href"], a["text"], None)
            url, page = onward, page + 1
