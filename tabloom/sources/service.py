"""Paged services as a Spark data source, for batches and streams.

    spark.dataSource.register(source("filings", fetch, "id string, day string", policy))
    spark.read.format("filings").option("since", "2024-01-01").option("until", "2024-03-31").load()
    spark.readStream.format("filings").option("since", "2024-01-01").load()

A window of days (of one scope, if there are scopes) is an input partition and is read
by one task; what a window needs beyond that, halving and reading from both ends, is in
paged.py. A stream's offset is its watermark, the last day that has been read: a batch
reads the days after it up to the service's newest one, and as many before it again as
`overlap` says, since services publish late. Rows of a window may repeat (both ends,
overlaps): latest or distinct by key what follows.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from datetime import date, datetime, timedelta, timezone
from functools import partial

from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

from .paged import Fetch, Policy, rows_of, with_retries


@dataclass
class Window(InputPartition):
    since: date
    until: date
    scope: str | None = None

    def __post_init__(self):
        super().__init__((self.since, self.until, self.scope))


def windows(since: date, until: date, days: int, scopes: Sequence[str | None] = (None,)) -> list[Window]:
    """Windows of so many days, for each scope; none if since is after until."""
    starts = range(0, (until - since).days + 1, days)
    return [Window(since + timedelta(k), min(until, since + timedelta(k + days - 1)), s) for s in scopes for k in starts]


def _today() -> date:
    return datetime.now(timezone.utc).date()


class _Reading:
    """What batch and stream readers share; works in the driver's planner and in tasks."""

    def __init__(self, schema: StructType, options, fetch: Fetch, policy: Policy, backwards: Fetch | None):
        self.names, self.fetch, self.policy, self.backwards = [f.name for f in schema], fetch, policy, backwards
        self.first = date.fromisoformat(options["since"]) if options.get("since") else None
        self.last = date.fromisoformat(options["until"]) if options.get("until") else None
        self.days = int(options.get("days", 30))
        self.scopes = json.loads(options["scopes"]) if options.get("scopes") else [None]

    def read(self, partition: Window | None) -> Iterator[tuple]:
        if partition is None:  # of a batch without a window
            return
        scoped = lambda f: f and with_retries(f if partition.scope is None else partial(f, scope=partition.scope), self.policy)
        for row in rows_of(scoped(self.fetch), partition.since, partition.until, self.policy, scoped(self.backwards)):
            yield tuple(row.get(n) for n in self.names)


class _Batch(_Reading, DataSourceReader):
    def partitions(self) -> list[Window]:
        if self.first is None:
            raise ValueError("a batch needs the option since")
        return windows(self.first, self.last or _today(), self.days, self.scopes)


class _Stream(_Reading, DataSourceStreamReader):
    def __init__(self, schema, options, fetch, policy, backwards, newest: Callable[[], date]):
        super().__init__(schema, options, fetch, policy, backwards)
        self.newest, self.overlap = newest, int(options.get("overlap", 0))
        if self.first is None:
            raise ValueError("a stream needs the option since")

    def initialOffset(self) -> dict:
        return {"day": str(self.first - timedelta(1))}

    def latestOffset(self) -> dict:
        day = self.newest() if self.last is None else min(self.last, self.newest())
        return {"day": str(max(day, self.first - timedelta(1)))}

    def partitions(self, start: dict, end: dict) -> list[Window]:
        after, upto = date.fromisoformat(start["day"]), date.fromisoformat(end["day"])
        if upto <= after:
            return []
        return windows(max(self.first, after + timedelta(1 - self.overlap)), upto, self.days, self.scopes)

    def commit(self, end: dict) -> None:
        pass


def source(name: str, fetch: Fetch, schema: str, policy: Policy = Policy(), backwards: Fetch | None = None, newest: Callable[[], date] | None = None) -> type[DataSource]:
    """A data source to register: fetch(since, until, page) as in paged.py, with a keyword scope
    where the option `scopes` (a JSON array of texts) is given.

    Options: since, until (days, both included; until is today, or what newest() says, by
    default), days of a window (30), scopes, and overlap of a stream in days (0).
    """
    stream_newest = newest or _today

    class Service(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return schema

        def reader(self, schema: StructType) -> DataSourceReader:
            return _Batch(schema, self.options, fetch, policy, backwards)

        def streamReader(self, schema: StructType) -> DataSourceStreamReader:
            return _Stream(schema, self.options, fetch, policy, backwards, stream_newest)

    return Service


class Recorded:
    """A fetch that answers from a folder of recorded pages, and records them first if it has a live one.

    A page is a JSON file named by what was asked. For tests and for runs that must be repeatable.
    """

    def __init__(self, folder: str, live: Fetch | None = None):
        self.folder, self.live = folder, live

    def __call__(self, since: date, until: date, page, **scope):
        import os

        asked = "_".join(str(x).replace("/", "-") for x in (since, until, page, *scope.values()))
        path = f"{self.folder}/{asked}.json"
        if self.live is not None:
            answer = self.live(since, until, page, **scope)
            os.makedirs(self.folder, exist_ok=True)
            with open(path, "w", encoding="utf-8") as f:
                json.dump(answer, f)
            return answer
        with open(path, encoding="utf-8") as f:
            rows, more, total = json.load(f)
        return rows, more, total
