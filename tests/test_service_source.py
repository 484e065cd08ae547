"""A recorded service read as a data source, in batch and as a stream."""

import json
from datetime import date, timedelta

import pytest

from tabloom.sources.paged import Policy
from tabloom.sources.service import Recorded, source, windows

SCHEMA = "id string, day string, scope string"
PER_DAY, PAGE = 7, 4


def live(since, until, page, scope=None, ceiling=None, backwards=False):
    """Seven rows a day, 30 on the tenth; a page of four; no page beyond the ceiling."""
    days = [since + timedelta(k) for k in range((until - since).days + 1)]
    rows = [{"id": f"{scope or ''}{d}-{k:02d}", "day": str(d), "scope": scope} for d in days for k in range(30 if d.day == 10 else PER_DAY)]
    total = len(rows)
    rows = rows[::-1] if backwards else rows
    if ceiling:
        rows = rows[:ceiling]
    return rows[page * PAGE : page * PAGE + PAGE], (page + 1) * PAGE < len(rows), total


def limited(since, until, page, **scope):
    return live(since, until, page, ceiling=20, **scope)


def from_the_end(since, until, page, **scope):
    return live(since, until, page, ceiling=20, backwards=True, **scope)


@pytest.fixture(scope="module")
def recorded(tmp_path_factory):
    """The pages that windows of January ask for, recorded by walking them once."""
    from tabloom.sources.paged import rows_of

    folder = str(tmp_path_factory.mktemp("pages"))
    front, back = Recorded(f"{folder}/front", limited), Recorded(f"{folder}/back", from_the_end)
    policy = Policy(ceiling=20)
    for days in (5, 31):
        for w in windows(date(2024, 1, 1), date(2024, 1, 20), days):
            list(rows_of(front, w.since, w.until, policy, back))
    return folder


def expected(first, last, scopes=("",)):
    days = [date.fromisoformat(first) + timedelta(k) for k in range((date.fromisoformat(last) - date.fromisoformat(first)).days + 1)]
    return sorted(f"{s}{d}-{k:02d}" for s in scopes for d in days for k in range(30 if d.day == 10 else PER_DAY))


@pytest.mark.parametrize("days", [5, 31])
def test_windows_are_partitions_halved_and_read_from_both_ends(spark, recorded, days):
    front, back = Recorded(f"{recorded}/front"), Recorded(f"{recorded}/back")
    spark.dataSource.register(source("recorded", front, SCHEMA, Policy(ceiling=20), back))
    df = spark.read.format("recorded").option("since", "2024-01-01").option("until", "2024-01-20").option("days", days).load()
    assert df.rdd.getNumPartitions() == -(-20 // days)
    assert sorted(r.id for r in df.dropDuplicates(["id"]).collect()) == expected("2024-01-01", "2024-01-20")
    spark.dataSource.register(source("one_end", front, SCHEMA, Policy(ceiling=20)))
    one = spark.read.format("one_end").option("since", "2024-01-01").option("until", "2024-01-20").option("days", days).load()
    assert one.count() == len(expected("2024-01-01", "2024-01-20")) - 10  # what one end can't reach of the tenth


def test_scopes_are_partitions_of_their_own(spark):
    spark.dataSource.register(source("scoped", live, SCHEMA))
    df = spark.read.format("scoped").option("since", "2024-02-01").option("until", "2024-02-03").option("scopes", json.dumps(["17-108", "x"])).load()
    assert df.rdd.getNumPartitions() == 2 and sorted(r.id for r in df.collect()) == expected("2024-02-01", "2024-02-03", ("17-108", "x"))
    assert spark.read.format("scoped").option("since", "2024-02-04").option("until", "2024-02-03").load().count() == 0


def test_a_stream_goes_on_after_its_watermark(spark, tmp_path):
    clock, out, ck = tmp_path / "today", str(tmp_path / "out"), str(tmp_path / "ck")
    place = str(clock)

    def newest():
        with open(place) as f:
            return date.fromisoformat(f.read())

    spark.dataSource.register(source("daily", live, SCHEMA, newest=newest))

    def run(day, overlap=0):
        clock.write_text(day)
        q = spark.readStream.format("daily").option("since", "2024-03-01").option("days", 2).option("overlap", overlap).load()
        q = q.writeStream.format("parquet").option("path", out).option("checkpointLocation", ck).trigger(once=True).start()
        q.awaitTermination()
        return sorted(r.id for r in spark.read.schema(SCHEMA).parquet(out).collect())

    assert run("2024-03-03") == expected("2024-03-01", "2024-03-03")
    assert run("2024-03-03") == expected("2024-03-01", "2024-03-03")  # no day is new
    assert run("2024-03-06") == expected("2024-03-01", "2024-03-06")
    assert run("2024-03-07", overlap=2) == sorted(expected("2024-03-01", "2024-03-07") + expected("2024-03-05", "2024-03-06"))


def test_transient_errors_are_tried_again(spark, tmp_path):
    marks = str(tmp_path)

    def flaky(since, until, page):
        import os

        path = f"{marks}/{since}-{page}"
        if not os.path.exists(path):
            open(path, "w").close()
            raise ConnectionError("reset")
        return live(since, until, page)

    spark.dataSource.register(source("flaky", flaky, SCHEMA, Policy(most_wait_s=0.01)))
    df = spark.read.format("flaky").option("since", "2024-01-01").option("until", "2024-01-02").option("days", 1).load()
    assert sorted(r.id for r in df.collect()) == expected("2024-01-01", "2024-01-02")
