from datetime import date

import pytest
from pyspark.sql import functions as F

from tabloom.operators import merge


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect()) if cols else sorted(map(tuple, df.collect()))


def test_latest_keeps_the_fresh_row_whole(spark):
    df = spark.createDataFrame([("a", "2024-01-01", "old", "x"), ("a", "2024-06-15", "new", None), ("b", None, "only-null", "y")], "id string, v string, t string, u string")
    assert rows(merge.latest(df, ["id"], "v")) == [("a", "2024-06-15", "new", None), ("b", None, "only-null", "y")]


def test_latest_of_three_and_null_versions(spark):
    df = spark.createDataFrame([("c1", "2024-01-01", "v1"), ("c1", "2024-02-01", "v2"), ("c1", "2024-03-01", "new"), ("c1", None, "nul"), ("c2", None, "only-null"), ("c3", "2024-01-01", "unique")], "id string, v string, t string")
    assert rows(merge.latest(df, ["id"], "v"), "id", "t") == [("c1", "new"), ("c2", "only-null"), ("c3", "unique")]


def test_latest_needs_its_columns(spark):
    with pytest.raises(ValueError):
        merge.latest(spark.createDataFrame([("a",)], "id string"), ["id"], "modify_date")


def test_ties_are_repeatable(spark):
    df = spark.createDataFrame([("a", "1", str(i)) for i in range(50)], "id string, v string, t string")
    assert len({rows(merge.latest(df.orderBy(F.rand(s)), ["id"], "v"))[0] for s in range(4)}) == 1


def test_merge_latest_evolves_the_schema(spark):
    old = spark.createDataFrame([("a", "2024-01-01"), ("b", "2024-01-01")], "id string, v string")
    new = spark.createDataFrame([("a", "2024-01-01", "text")], "id string, v string, note string")
    assert rows(merge.merge_latest(old, new, ["id"], "v"), "id", "note") == [("a", "text"), ("b", None)]
    assert rows(merge.merge_latest(None, new, ["id"], "v", {"id": "string", "v": "string"})) == [("a", "2024-01-01")]


def test_prefer_fresh_drops_null_keys(spark):
    prior = spark.createDataFrame([("a", 1), ("b", 1), (None, 1)], "k string, n int")
    fresh = spark.createDataFrame([("b", 2), ("c", 2), (None, 2)], "k string, n int")
    assert rows(merge.merge_prefer_fresh(prior, fresh, ["k"])) == [("a", 1), ("b", 2), ("c", 2)]
    assert rows(merge.merge_prefer_fresh(None, fresh, ["k"])) == [("b", 2), ("c", 2)]


@pytest.mark.parametrize("staged, want", [("2024-01-01", "table"), ("2024-06-15", "table"), ("2024-07-01", "staged")])
def test_upsert_takes_only_newer_rows(spark, staged, want):
    table = spark.createDataFrame([("a", "2024-06-15", "table"), ("z", None, "table")], "id string, v string, t string")
    new = spark.createDataFrame([("a", staged, "staged"), ("a", "2023-01-01", "stale"), ("n", None, "staged"), ("z", "2020-01-01", "staged")], "id string, v string, t string")
    assert rows(merge.upsert(table, new, "id", "v"), "id", "t") == [("a", want), ("n", "staged"), ("z", "staged")]


def test_update_where_present(spark):
    table = spark.createDataFrame([("a", None, None), ("b", "old", "ok"), ("c", None, None)], "id string, text string, status string")
    updates = spark.createDataFrame([("a", "new", "ok"), ("b", None, "error"), ("q", "x", "ok")], "id string, text string, status string")
    assert rows(merge.update_where_present(table, updates, "id", ["text", "status"])) == [("a", "new", "ok"), ("b", "old", "error"), ("c", None, None)]


def test_duplicate_audit(spark):
    df = spark.createDataFrame([("EPA", "1")] * 2 + [("EPA", "2")] * 3 + [("OMB", "3")] * 2 + [("FDA", "4")], "agency string, id string")
    assert [tuple(r) for r in merge.duplicate_audit(df, "agency", "id").select("agency", "rows", "distinct_keys").collect()] == [("EPA", 5, 2), ("OMB", 2, 1)]


def test_partition_index(spark):
    df = spark.createDataFrame([("EPA", '"EPA-1"', "2024-06-01T04:00:00Z"), ("EPA", "EPA-1", "2024-06-30T23:00:00-05:00"), (None, "x", "2024-06-01"), ("FDA", "FDA-1", "2024-05-01")], "agency string, docket string, posted string")
    index = merge.partition_index(merge.with_partition(df, "agency", "docket", "posted"), ["agency", "docket", "year", "month"])
    assert rows(index) == [("EPA", "EPA-1", 2024, 6, 2), ("FDA", "FDA-1", 2024, 5, 1)]
    changed = spark.createDataFrame([("EPA", "EPA-1", 2024, 6, 7)], index.schema)
    assert rows(merge.replace_partitions(index, changed, ["agency", "docket", "year", "month"])) == [("EPA", "EPA-1", 2024, 6, 7), ("FDA", "FDA-1", 2024, 5, 1)]


def test_watermarks_and_windows(spark):
    prior = spark.createDataFrame([("2024-03-10T00:00",), ("2024-03-15",), (None,), ("junk",)], "d string")
    assert merge.watermark(prior, "d", 7) == date(2024, 3, 8)
    assert merge.watermark(prior.filter("d = 'junk'"), "d", 7) is None and merge.watermark(None, "d", 7) is None
    assert merge.catch_up(date(2024, 1, 1), date(2024, 3, 1)) == (date(2024, 1, 1), date(2024, 1, 31))
    assert merge.catch_up(date(2024, 1, 1), date(2024, 1, 9)) == (date(2024, 1, 1), date(2024, 1, 9))
    with pytest.raises(ValueError):
        merge.catch_up(date(2024, 1, 2), date(2024, 3, 1), date(2024, 1, 1))
    assert {merge.rotating_year(date(2024, 1, d), 2020, 2022) for d in (1, 2, 3)} == {2020, 2021, 2022}


def test_bucketed_latest(spark):
    df = spark.createDataFrame([(str(i % 20), f"{i:03d}") for i in range(41)], "id string, v string")
    got = rows(merge.bucketed_latest(df, "id", "v", 10))
    assert len(got) == 20 and ("0", "040") in got
