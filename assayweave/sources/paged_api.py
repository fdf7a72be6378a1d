"""A Spark data source for paged JSON interfaces: one partition a batch of ids, retries with back-off.

``spark.read.format("paged_json").option("url", "https://…?ids={ids}&cursor={cursor}")``.
The pages' rows come out as JSON text; a page names its rows and the next cursor.
"""

from __future__ import annotations

import hashlib
import json
import os
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


def fetch(url: str, tries: int = 4, wait: float = 1.0, get: Callable[[str], bytes] | None = None) -> bytes:
    """The body of a url; waits twice as long after each failure, and gives up after ``tries``."""
    read = get or (lambda u: urllib.request.urlopen(u, timeout=60).read())
    for n in range(tries):
        try:
            return read(url)
        except (urllib.error.URLError, TimeoutError, ConnectionError):
            if n == tries - 1:
                raise
            time.sleep(wait * 2**n)
    raise AssertionError


def cached_fetch(url: str, path: str, sha256: str | None = None, **how) -> bytes:
    """The body of a url, kept in a file beside its use.

    A kept file is taken as it is if its SHA-256 is the stated one, or if none is stated.
    Else the url is read again; a body with another hash than the stated one is refused and
    leaves the kept file as it was.
    """
    if os.path.exists(path):
        with open(path, "rb") as kept:
            body = kept.read()
        if sha256 is None or hashlib.sha256(body).hexdigest() == sha256.lower():
            return body
    body = fetch(url, **how)
    if sha256 is not None and hashlib.sha256(body).hexdigest() != sha256.lower():
        raise ValueError(f"{url} has changed")
    with open(f"{path}.part", "wb") as new:
        new.write(body)
    os.replace(f"{path}.part", path)
    return body


def pages(url: str, ids: str, rows: str, cursor: str, get: Callable[[str], bytes] | None = None, wait: float = 1.0) -> Iterator[dict]:
    """Rows of all pages of one batch of ids, following the cursor until there is none."""
    at = ""
    while at is not None:
        page = json.loads(fetch(url.format(ids=ids, cursor=at), get=get, wait=wait))
        yield from page.get(rows) or []
        following = page.get(cursor)
        at = following if following and following != at else None


class PagedJson(DataSource):
    """Options: url, ids (comma-separated), batch, rows, cursor."""

    @classmethod
    def name(cls) -> str:
        return "paged_json"

    def schema(self) -> str:
        return "ids string, row string"

    def reader(self, schema) -> DataSourceReader:  # noqa: ANN001
        return _Reader(self.options)


class _Batch(InputPartition):
    def __init__(self, ids: str):
        self.ids = ids


class _Reader(DataSourceReader):
    def __init__(self, options):  # noqa: ANN001
        self.url, self.rows, self.cursor = options["url"], options.get("rows", "results"), options.get("cursor", "next")
        self.ids, self.batch = [x for x in options.get("ids", "").split(",") if x], int(options.get("batch", "50"))

    def partitions(self) -> list[_Batch]:
        return [_Batch(",".join(self.ids[i : i + self.batch])) for i in range(0, len(self.ids), self.batch)] or [_Batch("")]

    def read(self, partition: _Batch) -> Iterator[tuple[str, str]]:
        for row in pages(self.url, partition.ids, self.rows, self.cursor):
            yield partition.ids, json.dumps(row)
