import math

import pytest
from pyspark.sql import functions as F

from tabloom.operators import governance, graph, nearmatch, search


def test_bm25_prefers_the_rare_word(spark):
    df = spark.createDataFrame([(1, "ozone rule ozone"), (2, "rule rule rule"), (3, "nothing"), (4, None)], "id long, t string")
    got = search.bm25(df, "id", "t", "Ozone rule").collect()
    assert [r.id for r in got] == [1, 2] and got[0].score > got[1].score > 0
    with pytest.raises(ValueError):
        search.bm25(df, "id", "t", " !")


def test_vectors(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, 1.0]), (3, [0.0, 0.0]), (4, [0.0, 2.0])], "id long, v array<float>")
    got = search.vector_search(df, "id", "v", [2.0, 0.0], 5).collect()
    assert [(r.id, round(r.score, 6)) for r in got] == [(1, 1.0), (2, round(math.sqrt(0.5), 6)), (4, 0.0)]
    assert [r.id for r in search.similar_to(df, "id", "v", 2, 1).collect()] == [1]


def test_fusion_and_overlap(spark):
    a = spark.createDataFrame([(1, 9.0), (2, 8.0)], "id long, score double")
    b = spark.createDataFrame([(2, 1.0), (3, 0.5)], "id long, score double")
    got = search.fused([a, b], "id").collect()
    assert got[0].id == 2 and got[0].found_by == 2 and abs(got[0].score - (1 / 62 + 1 / 61)) < 1e-12
    assert sorted((r.id, r.found_in) for r in search.overlap(a, b, "id").collect()) == [(1, "first"), (2, "both"), (3, "second")]


def test_embedding(spark):
    df = spark.createDataFrame([(1, "abc"), (2, "")], "id long, t string")
    got = search.embedded(df, "id", F.col("t"), lambda ts: [[len(t), 0.0] for t in ts], 2).collect()
    assert [(r.id, r.embedding) for r in got] == [(1, [1.0, 0.0])]


def test_components(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 101), (103, 101), (7, 7), (None, 3)]
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert {got[i] for i in range(41)} == {0} and {got[i] for i in (100, 101, 103)} == {100} and len(got) == 44
    assert graph.components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_near_records(spark):
    t = "National Emission Limits for Hazardous Air Pollutants in Foundries"
    rows = [("1", "EPA", t, "2024-01-01", "same abstract"), ("2", "DOE", t, "2024-01-05", "same abstract"), ("3", "EPA", t + " Update", "2024-01-03", None), ("4", "FDA", "Labeling of Foods in Vending Machines and Kiosks", "2024-01-01", None), ("5", "X", "short", None, None), ("6", "Y", "Notice of Proposed Rulemaking", None, None)]
    recs = nearmatch.records(spark.createDataFrame(rows, "id string, a string, t string, m string, b string"), "id", "a", "t", "m", "b")
    assert sorted(r.id for r in recs.collect()) == ["1", "2", "3", "4"]
    pairs = nearmatch.scored(nearmatch.candidates(recs), recs)
    assert sorted((r.a, r.b) for r in pairs.collect()) == [("1", "2"), ("2", "3")]
    assert pairs.filter("a = '1'").first().score == 1.0
    found = nearmatch.clusters(pairs, recs, 0.7).collect()
    assert [(r.cluster, r.records, r.groups, r.span_days) for r in found] == [("1", 3, 2, 4)]
    assert nearmatch.clusters(pairs, recs, 0.7, dominant=0.6).count() == 0
    assert "cluster=1" in nearmatch.report(nearmatch.clusters(pairs, recs, 0.7)) and nearmatch.report(nearmatch.clusters(pairs, recs, 0.7), "csv").startswith("cluster")


def test_large_blocks_make_no_pairs(spark):
    rows = [(i, f"A{i}", f"alpha beta gamma {chr(97 + i)}{chr(97 + i)}{chr(97 + i)} delta epsilon") for i in range(26)]
    recs = nearmatch.records(spark.createDataFrame(rows, "id long, a string, t string"), "id", "a", "t", least_title=5)
    assert nearmatch.candidates(recs, 25).count() == 0 and nearmatch.candidates(recs, 26).count() == 26 * 25 // 2


def test_checks(spark):
    t = spark.createDataFrame([("2024-01-01",), ("2024-02-01",), ("x",)], "d string")
    budgets = [governance.Budget("t", "d", 3), governance.Budget("none", "d", 3)]
    latest = governance.latest_days({"t": t}, budgets)
    assert [(r.lag_days, r.ok, r.row_count) for r in governance.freshness(latest, budgets, "2024-02-04").collect()] == [(3, True, 3)]
    assert [r.ok for r in governance.freshness(latest, budgets, "2024-02-05").collect()] == [False]
    before = spark.createDataFrame([("t", 10)], "table_name string, row_count long")
    assert [r.ok for r in governance.count_changes(latest, before).collect()] == [False]
    assert governance.drift(["a", "b"], ["b", "c"], ["a"]) == {"missing_in_table": ["a"], "undeclared": ["c"], "undescribed": ["b"], "described_only": []}


def test_titles_are_joined_without_the_driver(spark, tmp_path):
    rows = [(i, f"ag{i % 3}", f"record number{i // 3} alpha{i // 3} beta{i // 3}") for i in range(300)]
    spark.createDataFrame(rows, "id long, a string, t string").write.parquet(str(tmp_path / "t"))
    recs = nearmatch.records(spark.read.parquet(str(tmp_path / "t")), "id", "a", "t", least_title=5)
    pairs = nearmatch.scored(nearmatch.candidates(recs), recs)
    found = nearmatch.clusters(pairs, recs, 0.6)
    assert found.count() == 100  # three agencies each
    for df in (pairs, found):
        assert "Broadcast" not in df._jdf.queryExecution().executedPlan().toString()
