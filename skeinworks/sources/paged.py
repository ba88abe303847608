"""A cursor-paged REST source as a Python data source; the page fetcher is given, so tests run on stored pages."""

from __future__ import annotations

import json
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

LIMIT, TIME_WINDOW = 100, "7d"


def pages(fetch: Callable[[str | None], dict], items: str = "frames") -> Iterator[dict]:
    """Items of all pages, following next.cursor; an empty page or no cursor ends it, an error keeps what was fetched."""
    cursor = None
    while True:
        try:
            got = fetch(cursor)
        except Exception:  # noqa: BLE001  the items so far are kept, as by the service's own client
            return
        found, cursor = got.get(items) or [], (got.get("next") or {}).get("cursor")
        yield from found
        if not found or not cursor:
            return


def http_fetcher(url: str, key: str, limit: int = LIMIT, time_window: str = TIME_WINDOW, timeout: float = 30.0) -> Callable[[str | None], dict]:
    """Pages of a service, asked for with a key in the header."""

    def fetch(cursor: str | None) -> dict:
        query = {"limit": limit, "time_window": time_window} | ({"cursor": cursor} if cursor else {})
        request = urllib.request.Request(f"{url}?{urllib.parse.urlencode(query)}", headers={"api_key": key, "accept": "application/json"})
        with urllib.request.urlopen(request, timeout=timeout) as answer:
            return json.load(answer)

    return fetch


def stored_fetcher(uri: str) -> Callable[[str | None], dict]:
    """Pages out of a JSON file, a list in order: a page's next.cursor leads to the one behind it."""
    from pyarrow import fs

    files, path = fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else "file://" + uri)
    with files.open_input_file(path) as f:
        stored = json.loads(f.read())
    after = {None: stored[0] if stored else {}}
    for one, two in zip(stored, stored[1:], strict=False):
        if cursor := (one.get("next") or {}).get("cursor"):
            after[cursor] = two
    return lambda cursor: after[cursor]


class PagedSource(DataSource):
    """spark.read.format("paged_json").options(url=..., key=...) or .option("pages", a JSON file of pages).load(): a row `raw` an item."""

    @classmethod
    def name(cls) -> str:
        return "paged_json"

    def schema(self) -> str:
        return "raw string"

    def reader(self, schema) -> DataSourceReader:
        return _Reader(dict(self.options))


class _Reader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.options = options

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(0)]  # a cursor has no second reader

    def read(self, partition):
        o = self.options
        if "pages" in o:
            fetch = stored_fetcher(o["pages"])
        else:
            fetch = http_fetcher(o["url"], o.get("key", ""), int(o.get("limit", LIMIT)), o.get("time_window", TIME_WINDOW))
        for item in pages(fetch, o.get("items", "frames")):
            yield (json.dumps(item),)
