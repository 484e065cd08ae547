import datetime as dt

import pytest
from pyspark.sql import functions as F

from tabloom.operators import rollups


def rows(df, *cols):
    return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=str)


def test_counts_over_missing_inputs(spark):
    d = spark.createDataFrame([("EPA",), ("EPA",), ("FDA",), (None,)], "agency string")
    index = spark.createDataFrame([("EPA", 3), ("OMB", 4)], "agency string, row_count bigint")
    assert rows(rollups.counts_over({"dockets": d, "documents": None, "comments": index}, "agency")) == [("EPA", 2, 0, 3), ("FDA", 1, 0, 0), ("OMB", 0, 0, 4)]
    with pytest.raises(FileNotFoundError):
        rollups.counts_over({"dockets": None}, "agency")


def test_feed_summary_joins_quoted_ids(spark):
    d = spark.createDataFrame([('"EPA-1"', "t"), ("FDA-1", "u")], "docket_id string, title string")
    c = spark.createDataFrame([("EPA-1",), ('"EPA-1"',)], "docket_id string")
    docs = spark.createDataFrame([('"EPA-1"', "2024-07-01", "2024-06-01")], "docket_id string, ends string, posted string")
    assert rows(rollups.feed_summary(d, "docket_id", c, docs, "ends", "posted")) == [("EPA-1", "t", 2, "2024-07-01", "2024-06-01"), ("FDA-1", "u", 0, None, None)]
    assert rows(rollups.feed_summary(d, "docket_id", None, None, "ends", "posted"), "comment_count", "date_created") == [(0, None), (0, None)]


@pytest.mark.parametrize("prior, recent, kept", [(24, 4, True), (23, 9, False), (24, 3, False), (48, 8, True), (0, 5, False)])
def test_spike_thresholds(spark, prior, recent, kept):
    old = [("A", dt.datetime(2024, 1, 1))] * prior
    new = [("A", dt.datetime(2024, 6, 20))] * recent
    df = spark.createDataFrame(old + new, "agency string, ts timestamp_ntz")
    assert bool(rollups.spike_signals(df, "agency", F.col("ts"), "2024-06-30").count()) is kept


def test_lifecycles(spark):
    d = dt.date
    proposed = spark.createDataFrame([("a", "X", d(2024, 1, 1)), ("a", "X", d(2023, 1, 1)), ("b", "X", d(2024, 5, 1)), ("c", "X", d(2024, 1, 1)), ("old", "X", d(2009, 1, 1)), ("n", "X", None)], "k string, g string, day date")
    final = spark.createDataFrame([("a", d(2024, 2, 1)), ("a", d(2024, 3, 1)), ("b", d(2024, 4, 1)), ("n", d(2024, 1, 1))], "k string, day date")
    assert rows(rollups.lifecycles(proposed, final, "k", "g", "day"), "k", "kind", "days") == [("a", "pair", 396), ("c", "stuck", None)]


def test_exploded_links(spark):
    df = spark.createDataFrame([("1", ["a", " ", None, "b"]), ("2", []), ("3", None)], "id string, x array<string>")
    assert rows(rollups.exploded_links(df, F.col("x"), "link", ["id"])) == [("a", "1"), ("b", "1")]


def test_texts(spark):
    df = spark.createDataFrame([("x", "same", 1), ("x", "same", 3), ("x", "other", 2), ("y", None, 4)], "g string, t string, d int")
    assert rows(rollups.repeated_texts(df, "t", "d")) == [("same", 2, 1, 3)]
    assert rows(rollups.unique_texts(df, "t"), "t") == [("other",)]
    assert rows(rollups.distinct_share(df, "g", "t", 2)) == [("x", 3, 2, 33.3)]
    assert rows(rollups.templates(df, "t", 1, 0)) == [("o", 1, 1), ("s", 2, 1)]
    words = spark.createDataFrame([("The rule harms people, people say",)], "t string")
    assert dict(rows(rollups.word_counts(words, "t"))) == {"rule": 1, "harms": 1, "people": 2}
    assert dict(rows(rollups.bigram_counts(words, "t")))["people people"] == 1


def test_search_documents(spark):
    df = spark.createDataFrame([("1", "a", "old", "2023"), ("1", "b", "", "2024"), ("2", "", "", "2024")], "id string, title string, body string, v string")
    assert rows(rollups.search_documents(df, "id", F.col("title"), F.col("body"), "v")) == [("1", "b", None, "2024")]


def test_ends_and_sample(spark):
    df = spark.range(50)
    assert rows(rollups.ends(df, 2, "id")) == [(0, 1, "early"), (1, 2, "early"), (48, 2, "late"), (49, 1, "late")]
    assert rows(rollups.exact_sample(df, 7, 1, "id")) == rows(rollups.exact_sample(df.orderBy(F.desc("id")), 7, 1, "id"))
    assert rollups.exact_sample(df, 7, 1, "id").count() == 7


def test_spike_days(spark):
    days = [(dt.datetime(2024, 1, 1 + i),) for i in range(20)] + [(dt.datetime(2024, 1, 5),)] * 30
    assert [r.day for r in rollups.spike_days(spark.createDataFrame(days, "ts timestamp_ntz"), F.col("ts")).collect()] == [dt.date(2024, 1, 5)]
