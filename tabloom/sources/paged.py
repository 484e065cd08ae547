"""A data source for paged services, offline by default.

The service is a picklable function fetch(since, until, page) that returns the rows of
a page (dicts), whether more pages follow, and the number of rows that the window has
in all (None if unknown). Pages are numbered; a service that has cursors, keys or links
gives the next one instead of True, and is asked for that. Windows are the source's partitions; a window over a service's
ceiling is halved down to a day, and a day over it is read from both ends.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.session import ship

Fetch = Callable[[date, date, object], tuple[list[dict], object, int | None]]


@dataclass(frozen=True)
class Policy:
    ceiling: int | None = None  # rows that a window may have, else it is halved
    most_pages: int = 10_000
    stop_on_empty: bool = False  # a short page isn't the last one
    attempts: int = 4
    most_wait_s: float = 30.0
    enough: Callable[[dict], bool] | None = None  # of rows in order: the first one that needs no reading, nor what follows


def with_retries(fetch: Fetch, policy: Policy, sleep=None) -> Fetch:
    """fetch, tried again after transient errors (OSError), waiting twice as long each time."""
    import time

    wait = sleep or time.sleep

    def run(since: date, until: date, page: int):
        for k in range(policy.attempts):
            try:
                return fetch(since, until, page)
            except OSError:
                if k + 1 == policy.attempts:
                    raise
                wait(min(policy.most_wait_s, 2.0**k))

    return run


def rows_of(fetch: Fetch, since: date, until: date, policy: Policy, backwards: Fetch | None = None) -> Iterator[dict]:
    """All rows of a window, halving it where it is over the ceiling."""
    rows, more, total = fetch(since, until, 0)
    if policy.ceiling and total is not None and total > policy.ceiling:
        if since < until:
            middle = since + (until - since) // 2
            yield from rows_of(fetch, since, middle, policy, backwards)
            yield from rows_of(fetch, middle + timedelta(days=1), until, policy, backwards)
            return
        if backwards is not None:  # what one end can't reach, the other may; copies go by key later
            yield from _pages(backwards, since, until, policy, *backwards(since, until, 0)[:2])
    yield from _pages(fetch, since, until, policy, rows, more)


def _pages(fetch: Fetch, since: date, until: date, policy: Policy, rows: list[dict], more: bool) -> Iterator[dict]:
    for page in range(1, policy.most_pages + 1):
        for row in rows:
            if policy.enough and policy.enough(row):
                return
            yield row
        if policy.stop_on_empty and not rows or not policy.stop_on_empty and not more:
            return
        rows, more, _ = fetch(since, until, page if isinstance(more, bool) else more)


def read(spark: SparkSession, fetch: Fetch, windows: DataFrame, schema: str, key: str | None = None, policy: Policy = Policy(), backwards: Fetch | None = None) -> DataFrame:
    """Rows of all windows (since, until), each read by one task; one row for each key."""
    import pandas as pd
    from pyspark.sql.types import StructType

    ship(spark)
    names = [f.name for f in StructType.fromDDL(schema)]
    get, back = with_retries(fetch, policy), backwards and with_retries(backwards, policy)

    def run(frames):
        for f in frames:
            for w in f.itertuples():
                batch = []
                for r in rows_of(get, w.since, w.until, policy, back):
                    batch.append([r.get(n) for n in names])
                    if len(batch) == 1000:
                        yield pd.DataFrame(batch, columns=names)
                        batch = []
                if batch:
                    yield pd.DataFrame(batch, columns=names)

    spread = windows.repartitionByRange(max(1, windows.count()), "since")
    out = spread.mapInPandas(run, schema)
    return out.dropDuplicates([key]).filter(F.col(key).isNotNull()) if key else out


def nested(parents: DataFrame, fetch: Callable[[dict, object], tuple[list[dict], object]], schema: str, stamp: list[str], policy: Policy = Policy()) -> DataFrame:
    """Rows of a listing within each parent row: fetch(parent, page) gives the rows of a page
    and whether (or where) more follow. Every row carries the parent's columns `stamp`.
    Parents are spread over tasks, so that no task reads a whole catalogue."""
    import pandas as pd
    from pyspark.sql.types import StructType

    spark = parents.sparkSession
    ship(spark)
    own = [f.name for f in StructType.fromDDL(schema)]
    types = dict(parents.dtypes)

    def run(frames):
        get = with_retries(lambda parent, _, page: fetch(parent, page), policy)
        for f in frames:
            for parent in f.to_dict("records"):
                page, more = 0, True
                for number in range(1, policy.most_pages + 1):
                    rows, more = get(parent, None, page)
                    if rows:
                        yield pd.DataFrame([[*(parent[c] for c in stamp), *(r.get(n) for n in own)] for r in rows], columns=[*stamp, *own])
                    if policy.stop_on_empty and not rows or not policy.stop_on_empty and not more:
                        break
                    page = number if isinstance(more, bool) else more

    return parents.repartition(*stamp).mapInPandas(run, ", ".join([*(f"`{c}` {types[c]}" for c in stamp), schema]))
