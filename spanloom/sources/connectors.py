"""Replaceable connectors: the model service (replayed by default) and a paged metadata source, offline."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator
from pathlib import Path
from typing import Protocol

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


class ModelClient(Protocol):
    """Answers requests; a remote client retries inside and never lets Spark repeat a whole partition for one call."""

    def answer(self, requests: DataFrame) -> DataFrame:
        """(key, finish, body, tokens_in, tokens_out) for requests (key, request)."""


class ReplayClient:
    """Answers from stored responses, by key."""

    def __init__(self, responses: DataFrame) -> None:
        self.responses = responses

    def answer(self, requests: DataFrame) -> DataFrame:
        return self.responses.join(requests.select("key"), "key", "left_semi")


class CallClient:
    """Answers by a function of (key, request as JSON) -> (finish, body, tokens_in, tokens_out), called in the workers, with retries."""

    def __init__(self, call: Callable[[str, str], tuple[str, str, int, int]], tries: int = 5) -> None:
        self.call, self.tries = call, tries

    def answer(self, requests: DataFrame) -> DataFrame:
        call, tries = self.call, self.tries

        def once(key: str, request: str) -> tuple[str, str, int, int]:
            for left in range(tries, 0, -1):
                try:
                    return call(key, request)
                except OSError:
                    if left == 1:
                        return "ERROR", "", 0, 0
            raise AssertionError

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keys = batch.column(0).to_pylist()
                rows = [once(k, r) for k, r in zip(keys, batch.column(1).to_pylist())]
                kinds = (pa.string(), pa.string(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds))], ["key", "finish", "body", "tokens_in", "tokens_out"])

        return requests.selectExpr("key", "to_json(request) AS request").mapInArrow(run, "key string, finish string, body string, tokens_in long, tokens_out long")


class Busy(Exception):
    """The service asks to come back later."""


def walk_pages(fetch: Callable[[str], dict], first: str = "*", tries: int = 5, wait: float = 1.0, sleep: Callable[[float], None] = time.sleep) -> Iterator[dict]:
    """The results of a cursor-paged source: ``fetch`` takes a cursor and gives {"results": [...], "meta": {"next_cursor": ...}}.

    A busy service is asked again after a wait that doubles, ``tries`` times at most; other errors are not retried.
    """
    cursor: str | None = first
    while cursor:
        for left in range(tries - 1, -1, -1):
            try:
                page = fetch(cursor)
                break
            except Busy:
                if not left:
                    raise
                sleep(wait * 2 ** (tries - 1 - left))
        yield from page.get("results", [])
        cursor = (page.get("meta") or {}).get("next_cursor") if page.get("results") else None


class PagedWorks(DataSource):
    """Works of a metadata service, offline: ``spark.read.format("paged_works").load(folder)``.

    Every subfolder (one query of the service) or the folder itself is a partition: its pages are replayed from
    ``page_*.json`` by their cursors, the first being ``*``; pages without cursors follow each other by name.  A live reader has the
    same shape, with a call to the service as ``fetch``.
    """

    @classmethod
    def name(cls) -> str:
        return "paged_works"

    def schema(self) -> str:
        return "id string, doi string, title string, type string, publication_date string, body string"

    def reader(self, schema) -> DataSourceReader:  # noqa: ANN001
        return _Pages(self.options["path"])


class _Pages(DataSourceReader):
    def __init__(self, folder: str) -> None:
        self.folder = folder

    def partitions(self) -> list[InputPartition]:
        folders = {p.parent for p in Path(self.folder).rglob("page_*.json")}
        return [InputPartition(str(p)) for p in sorted(folders)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        pages = sorted(Path(partition.value).glob("page_*.json"))

        def fetch(cursor: str) -> dict:
            k = 0 if cursor == "*" else next(i for i, p in enumerate(pages) if p.stem == cursor)
            page = json.loads(pages[k].read_text())
            return page | {"meta": {"next_cursor": pages[k + 1].stem if k + 1 < len(pages) else None}}

        for w in walk_pages(fetch):
            yield w.get("id"), w.get("doi"), w.get("title"), w.get("type"), w.get("publication_date"), json.dumps(w)
