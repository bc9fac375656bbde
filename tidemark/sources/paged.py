"""Paged and sliced remote tables as a Spark data source.

The transport is a parameter: ``getter`` names a function ``module:name`` that takes the endpoint and a dict of request
parameters and returns the decoded JSON answer. A window of time is cut into contiguous slices and each slice is a partition, so
executors page through slices side by side; within a slice pages follow the answer's cursor.
"""

from __future__ import annotations

import importlib
import json
import time
from collections.abc import Callable, Iterator
from typing import Any

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from tidemark.streaming.ingest import slices

Getter = Callable[[str, dict[str, Any]], dict[str, Any]]


class Slice(InputPartition):
    def __init__(self, low: int, high: int):
        self.low, self.high = low, high


def resolve(name: str) -> Getter:
    module, _, attribute = name.partition(":")
    return getattr(importlib.import_module(module), attribute)


def with_retries(get: Getter, tries: int = 5, wait: float = 0.5) -> Getter:
    """The getter, tried again after growing waits."""

    def call(endpoint: str, parameters: dict[str, Any]) -> dict[str, Any]:
        for attempt in range(tries):
            try:
                return get(endpoint, parameters)
            except (OSError, ValueError):
                if attempt == tries - 1:
                    raise
                time.sleep(wait * 2**attempt)
        raise AssertionError

    return call


def pages(get: Getter, endpoint: str, parameters: dict[str, Any], items: str, most: int | None = None) -> Iterator[dict[str, Any]]:
    """The items of all pages: each answer names the next cursor, the last an empty one."""
    cursor, n = "", 0
    while most is None or n < most:
        answer = get(endpoint, parameters | ({"cursor": cursor} if cursor else {}))
        yield from answer.get(items) or []
        cursor, n = answer.get("cursor") or "", n + 1
        if not cursor:
            return


def ranges_of(get: Getter, endpoint: str, low: int, high: int, items: str, chunk: int = 1000) -> Iterator[dict[str, Any]]:
    """The items of a range of blocks, in chunks; a chunk that is refused as too large is halved."""
    todo = [(s, min(s + chunk - 1, high)) for s in range(low, high + 1, chunk)][::-1]
    while todo:
        a, b = todo.pop()
        try:
            yield from get(endpoint, {"from": a, "to": b}).get(items) or []
        except OverflowError:
            if a == b:
                raise
            middle = (a + b) // 2
            todo += [(middle + 1, b), (a, middle)]


class PagedReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict[str, str]):
        self.names, self.options = schema.names, options

    def partitions(self) -> list[Slice]:
        o = self.options
        return [Slice(a, b) for a, b in slices(int(o["min_exclusive"]), int(o["max_inclusive"]), int(o.get("slice_hours", 0)), int(o.get("extra_seconds", 0)))]

    def read(self, partition: Slice) -> Iterator[tuple]:
        o = self.options
        get = with_retries(resolve(o["getter"]))
        parameters = {"min_ts": partition.low, "max_ts": partition.high, "limit": int(o.get("limit", 1000))}
        for item in pages(get, o["endpoint"], parameters, o["items"], int(o["max_pages"]) if "max_pages" in o else None):
            yield (json.dumps(item),)


class PagedSource(DataSource):
    """``spark.dataSource.register(PagedSource)``, then ``spark.read.format("paged")`` with options
    getter, endpoint, items, min_exclusive, max_inclusive and optionally slice_hours, extra_seconds, limit, max_pages.
    Rows are JSON texts, for ``tables.from_api``."""

    @classmethod
    def name(cls) -> str:
        return "paged"

    def schema(self) -> str:
        return "json string"

    def reader(self, schema: StructType) -> PagedReader:
        return PagedReader(schema, dict(self.options))
