"""Pages as a Spark sink: ``df.write.format("gleanery_pages")`` sends payloads and text blocks, and marks what arrived.

Each task sends the requests of its rows and keeps their sync events beside them; its message to the driver holds a name
and three counts, whatever the number of pages. Only a commit publishes what the tasks of a job have sent, so a job that
fails leaves no page and no event, and a task that ran twice counts once. Page ids follow from keys, so a page that is
sent again is the same page.
"""

from __future__ import annotations

import hashlib
import json
import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType

#: Blocks that one request may carry.
PER_REQUEST = 100
#: Rows of a batch that are Python objects at a time.
SLICE = 64


@dataclass
class Sent(WriterCommitMessage):
    name: str
    pages: int
    requests: int
    blocks: int


class FolderService:
    """A folder that driver and executors share stands in for the service: requests are lines of files."""

    def __init__(self, path: str):
        if "://" in path and not path.startswith("file://"):
            raise ValueError("the folder that stands in for the service must be mounted everywhere (file://)")
        self.path = path.removeprefix("file://")

    def _file(self, kind: str, name: str, staged: bool) -> str:
        folder = f"{self.path}/_staged/{kind}" if staged else f"{self.path}/{kind}"
        os.makedirs(folder, exist_ok=True)
        return f"{folder}/{name}.json"

    def open(self, kind: str, name: str):
        return open(self._file(kind, name, True), "w", encoding="utf-8")

    def publish(self, name: str) -> None:
        for kind in ("requests", "events"):
            if os.path.exists(staged := self._file(kind, name, True)):
                os.replace(staged, self._file(kind, name, False))

    def discard(self, name: str) -> None:
        for kind in ("requests", "events"):
            if os.path.exists(staged := self._file(kind, name, True)):
                os.remove(staged)


class PageWriter(DataSourceWriter):
    def __init__(self, options: dict):
        self.service, self.most, self.at = FolderService(options["path"]), int(options.get("perrequest", PER_REQUEST)), options.get("at")

    def write(self, iterator: Iterator) -> Sent:
        sent = Sent(uuid.uuid4().hex, 0, 0, 0)
        try:
            with self.service.open("requests", sent.name) as requests, self.service.open("events", sent.name) as events:
                for key, payload, found in iterator:  # rows carry no names here
                    event = {"key": key, "at": self.at, "state": "synced", "page_id": None, "error": None}
                    if key is None or payload is None:
                        event |= {"state": "failed", "error": "no key" if key is None else "no payload"}
                    else:
                        event["page_id"] = "page-" + hashlib.sha256(key.encode()).hexdigest()[:24]
                        blocks = list(found or [])
                        for k in range(0, max(len(blocks), 1), self.most):
                            request = {"page_id": event["page_id"], "key": key, "request": k // self.most, "blocks": blocks[k : k + self.most]}
                            requests.write(json.dumps(request | ({} if k else {"payload": payload})) + "\n")
                            sent.requests += 1
                        sent.pages += 1
                        sent.blocks += len(blocks)
                    events.write(json.dumps(event) + "\n")
        except BaseException:
            self.service.discard(sent.name)
            raise
        return sent

    def commit(self, messages: list) -> None:
        for m in messages:
            if m is not None:
                self.service.publish(m.name)

    def abort(self, messages: list) -> None:
        for m in messages:
            if m is not None:
                self.service.discard(m.name)


class ArrowPageWriter(PageWriter, DataSourceArrowWriter):
    """A PageWriter that takes Spark's batches as they come and makes SLICE rows of them at a time, so a worker holds a batch once."""

    def write(self, batches: Iterator) -> Sent:
        def rows():
            for batch in batches:
                for first in range(0, batch.num_rows, SLICE):
                    yield from zip(*(c.to_pylist() for c in batch.slice(first, SLICE).columns), strict=True)

        return super().write(rows())


class PageSink(DataSource):
    """Rows (key string, payload string, blocks array of strings); options ``path``, ``perRequest``, ``at``."""

    @classmethod
    def name(cls) -> str:
        return "gleanery_pages"

    def writer(self, schema: StructType, overwrite: bool) -> ArrowPageWriter:
        if overwrite:
            raise ValueError("pages are added or changed; the sink never clears the service")
        if [f.name for f in schema] != ["key", "payload", "blocks"]:
            raise ValueError("rows must be (key, payload, blocks)")
        return ArrowPageWriter(dict(self.options))


def push_pages(rows: DataFrame, key: Column, payload: Column, blocks: Column, path: str, at: str, per_request: int = PER_REQUEST) -> None:
    """Send every row as a page; requests and sync events lie under ``path`` when the job has succeeded.

    Rows without a key or payload are failures with an event and no request.
    """
    rows.sparkSession.dataSource.register(PageSink)
    pages = rows.select(key.cast("string").alias("key"), payload.alias("payload"), blocks.alias("blocks"))
    pages.write.format("gleanery_pages").mode("append").option("path", path).option("perRequest", per_request).option("at", at).save()
