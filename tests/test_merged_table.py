"""The log-structured table: crashes, replays, several streams, refreshes, and what is written."""

import os
import threading

import pytest

from tabloom.streaming import ingest as module
from tabloom.streaming.ingest import MergedTable, ingest

SCHEMA = "id string, v string, t string"


def got(table):
    return sorted(map(tuple, table.read().select("id", "v", "t").collect()))


def rows(spark, *values):
    return spark.createDataFrame(list(values), SCHEMA)


def parquet_bytes(path):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet"))


@pytest.mark.parametrize("step", ["latest", "_commit", "_tidy", "_clean"])
def test_a_crash_between_steps_loses_nothing(spark, tmp_path, monkeypatch, step):
    table = MergedTable(spark, str(tmp_path / "t"), ["id"], "v", buckets=4)
    table.merge(rows(spark, ("a", "1", "x"), ("b", "1", "x")), 0)
    table.merge(rows(spark, ("c", "1", "x")), 1)
    first, batch = got(table), rows(spark, ("a", "2", "y"), ("d", "1", "x"))

    def crash(*a, **k):
        raise RuntimeError("gone")

    with monkeypatch.context() as m:
        m.setattr(module if step == "latest" else table, step, crash)
        with pytest.raises(RuntimeError):
            table.merge(batch, 2)
    after = [("a", "2", "y"), ("b", "1", "x"), ("c", "1", "x"), ("d", "1", "x")]
    assert got(table) == (first if step in ("latest", "_commit") else after)
    table.merge(batch, 2)  # replayed
    assert got(table) == after
    table.merge(rows(spark, ("b", "3", "z")), 3)
    assert got(table) == [after[0], ("b", "3", "z"), *after[2:]]


@pytest.mark.parametrize("step", ["_replaced", "_commit", "write_partitioned"])
def test_a_crash_while_compacting_loses_nothing(spark, tmp_path, monkeypatch, step):
    table = MergedTable(spark, str(tmp_path / "t"), ["id"], "v", buckets=4, large_share=1e9)
    table.refresh(rows(spark, ("a", "0", "base"), ("z", "0", "base")))
    for n in range(3):
        table.merge(rows(spark, ("a", str(n), "x"), (f"k{n}", "1", "x")), n)
    before = got(table)

    def crash(*a, **k):
        raise RuntimeError("gone")

    with monkeypatch.context() as m:
        m.setattr(module if step == "write_partitioned" else table, step, crash)
        with pytest.raises(RuntimeError):
            table.compact()
    assert got(table) == before and len(table.state()["deltas"]) == 3
    assert table.compact() and got(table) == before and not table.state()["deltas"] and not table.compact()
    assert table.vacuum(0) >= (step != "write_partitioned") and got(table) == before


def test_streams_are_told_apart(spark, tmp_path):
    """Batch 0 of a new checkpoint or another stream isn't one that was there."""
    table = MergedTable(spark, str(tmp_path / "t"), ["id"], "v")
    assert table.merge(rows(spark, ("1", "1", "x")), 0, "a") and table.merge(rows(spark, ("2", "1", "x")), 0, "b")
    assert not table.merge(rows(spark, ("3", "1", "x")), 0, "a") and table.merge(rows(spark, ("4", "1", "x")), 1, "a")
    assert [r[0] for r in got(table)] == ["1", "2", "4"]


def test_microbatches_of_a_new_checkpoint_and_a_second_source(spark, tmp_path):
    src, other, out = (str(tmp_path / x) for x in ("src", "other", "out"))
    for part in ([("a", "1", "x"), ("b", "1", "x")], [("a", "3", "y")], [("a", "2", "late"), ("c", "1", "z")]):
        rows(spark, *part).coalesce(1).write.mode("append").parquet(src)
    table = MergedTable(spark, out, ["id"], "v")
    ingest(spark, src, SCHEMA, table, str(tmp_path / "c1"), 1).awaitTermination()
    want = [("a", "3", "y"), ("b", "1", "x"), ("c", "1", "z")]
    assert got(table) == want and len(table.state()["streams"]) == 1
    ingest(spark, src, SCHEMA, table, str(tmp_path / "c1"), 1).awaitTermination()  # nothing new
    version = table.state()["version"]
    rows(spark, ("b", "0", "older"), ("d", "1", "n")).coalesce(1).write.parquet(other)
    ingest(spark, other, SCHEMA, table, str(tmp_path / "c2"), 1).awaitTermination()  # its batch is number 0 too
    assert got(table) == [*want, ("d", "1", "n")]
    rows(spark, ("a", "3", "again")).coalesce(1).write.mode("append").parquet(src)
    ingest(spark, src, SCHEMA, table, str(tmp_path / "c3"), 1).awaitTermination()  # a full refresh: all files again
    assert got(table) == [("a", "3", "again"), *want[1:], ("d", "1", "n")] and table.state()["version"] > version + 3
    assert len(table.state()["streams"]) == 3


def test_what_is_written_follows_the_batch(spark, tmp_path):
    path = str(tmp_path / "t")
    table = MergedTable(spark, path, ["id"], "v", buckets=8)
    large = spark.range(200_000).selectExpr("string(id) AS id", "'1' AS v", "sha2(string(id), 256) AS t")
    table.refresh(large)
    base = parquet_bytes(path)
    files = {f for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}
    table.merge(spark.range(500).selectExpr("string(id) AS id", "'2' AS v", "'y' AS t"), 0)  # touches every bucket
    assert parquet_bytes(path) - base < 0.01 * base and files <= {f for d, _, names in os.walk(path) for f in names}
    assert table.read().count() == 200_000 and table.read().filter("t = 'y'").count() == 500
    table.merge(spark.createDataFrame([], SCHEMA), 1)
    assert table.read().count() == 200_000 and len(table.state()["deltas"]) == 1
    plan = table.read()._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" in plan and "LeftSemi" in plan


def test_deltas_are_folded_and_then_merged(spark, tmp_path):
    table = MergedTable(spark, str(tmp_path / "t"), ["id"], "v", buckets=4, most_deltas=3, large_share=0.5)
    table.refresh(spark.range(50_000).selectExpr("string(id) AS id", "'0' AS v", "sha2(string(id), 256) AS t"))
    seen = set()
    for n in range(7):
        table.merge(rows(spark, *((str(i), str(n + 1), f"b{n}") for i in range(n, n + 5))), n)
        seen.add(len(table.state()["deltas"]))
    assert seen == {1, 2} and table.state()["streams"] == {"": 6}
    assert table.read().filter("v <> '0'").count() == 11 and table.read().count() == 50_000
    table.merge(spark.range(40_000).selectExpr("string(id) AS id", "'9' AS v", "sha2(string(id), 224) AS t"), 7)
    assert not table.state()["deltas"] and table.read().filter("v = '9'").count() == 40_000 and table.read().count() == 50_000


def test_a_refresh_replaces_everything(spark, tmp_path):
    table = MergedTable(spark, str(tmp_path / "t"), ["id"], "v", buckets=4)
    table.merge(rows(spark, ("a", "9", "x"), ("b", "1", "x")), 0)
    table.refresh(rows(spark, ("a", "1", "new"), ("c", "1", "new"), ("c", "2", "newer")))
    assert got(table) == [("a", "1", "new"), ("c", "2", "newer")]
    table.merge(rows(spark, ("d", "1", "x")), 1)
    assert got(table) == [("a", "1", "new"), ("c", "2", "newer"), ("d", "1", "x")]


def test_two_writers_at_once(spark, tmp_path):
    path = str(tmp_path / "t")
    failed = []

    def write(stream):
        try:
            table = MergedTable(spark, path, ["id"], "v", buckets=2, most_deltas=3)
            for n in range(4):
                table.merge(rows(spark, (f"{stream}{n}", "1", "x"), ("both", f"{n}", stream)), n, stream)
        except Exception as e:
            failed.append(e)

    threads = [threading.Thread(target=write, args=(s,)) for s in "ab"]
    [t.start() for t in threads]
    [t.join() for t in threads]
    table = MergedTable(spark, path, ["id"], "v")
    assert not failed and [r[0] for r in got(table)] == sorted([f"{s}{n}" for s in "ab" for n in range(4)] + ["both"])
    assert table.state()["streams"] == {"a": 3, "b": 3}


def test_nulls_ties_repeats_and_new_columns(spark, tmp_path):
    table = MergedTable(spark, str(tmp_path / "t"), ["id", "t"], "v", buckets=3)
    table.merge(rows(spark, (None, "1", "x"), (None, "2", "x"), ("a", None, None), ("a", None, None)), 0)
    table.merge(spark.createDataFrame([("a", None, None, 7), ("b", "1", "x", None)], SCHEMA + ", more int"), 1)
    want = [(None, "2", "x", None), ("a", None, None, 7), ("b", "1", "x", None)]
    key = lambda r: (r[0] or "", r[1] or "")
    assert sorted(map(tuple, table.read().select("id", "v", "t", "more").collect()), key=key) == want
    table.compact()
    assert sorted(map(tuple, table.read().select("id", "v", "t", "more").collect()), key=key) == want
    assert MergedTable(spark, str(tmp_path / "none"), ["id"], "v").read() is None
