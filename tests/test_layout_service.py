import gzip
import json

import pytest
from pyspark.sql import functions as F

from tabloom.operators import enrich, layout
from tabloom.plans.pipeline import Rollup, chain, run_all
from tabloom.plans.service import Service, jsonable, seconds
from tabloom.streaming.ingest import MergedTable, ingest, stream_id


def test_swap_guards_and_resumes(spark, tmp_path):
    path = str(tmp_path / "t")
    assert layout.swap(spark.range(10).toDF("id"), path, ["id"]) == 10
    with pytest.raises(layout.Shrunk):
        layout.swap(spark.range(3).toDF("id"), path, least_ratio=0.5)
    assert spark.read.parquet(path).count() == 10
    assert layout.swap(spark.read.parquet(path).filter("id > 2"), path, least_ratio=0.5) == 7
    (tmp_path / "t").rename(tmp_path / "t.__ready")
    assert layout.resume(spark, path) and spark.read.parquet(path).count() == 7 and not layout.resume(spark, path)
    with pytest.raises(layout.Shrunk):
        layout.guard(5, None, least_rows=6)


def test_partitions_are_overwritten_alone(spark, tmp_path):
    path = str(tmp_path / "p")
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4)], "g string, n int")
    layout.write_partitioned(df, path, ["g"], ["n"])
    layout.write_partitioned(spark.createDataFrame([("a", 9)], "g string, n int"), path, ["g"])
    assert sorted((r.g, r.n) for r in spark.read.parquet(path).collect()) == [("a", 9), ("b", 3)]


def test_files(spark, tmp_path):
    df = spark.createDataFrame([(1, "x,y", None)], "id int, t string, n string")
    layout.write_csv(df, str(tmp_path / "c"))
    assert spark.read.option("header", True).csv(str(tmp_path / "c")).first().t == "x,y"
    layout.write_clustered(df, str(tmp_path / "k"), ["id"])
    doc = json.loads(gzip.decompress(layout.envelope(df)))
    assert doc == {"version": 1, "count": 1, "docs": [{"id": 1, "t": "x,y"}]}
    with pytest.raises(ValueError):
        layout.envelope(spark.range(3), most=2)
    layout.create_if_missing(spark, str(tmp_path / "e"), ["a", "b"])
    assert spark.read.parquet(str(tmp_path / "e")).dtypes == [("a", "string"), ("b", "string")]
    assert "| t | string | the text |" in layout.describe_markdown(df, "x", {"t": "the text"})


def test_rollup_runs(spark, tmp_path):
    spark.range(4).write.parquet(str(tmp_path / "a.parquet"))
    build = lambda a, b: a.withColumn("b", F.lit(b is not None))
    ok, bad = Rollup("out", build, ("a", "b"), order=["id"]), Rollup("bad", build, ("a", "b"), ("b",))
    got = run_all(spark, str(tmp_path), [bad, ok])
    assert got["out"] == 4 and str(got["bad"]).startswith("failed")
    assert chain(lambda d: d.filter("id > 1"), lambda d: d.limit(1))(spark.range(4)).count() == 1


@pytest.fixture(scope="module")
def service(spark):
    def build(session):
        session.range(100).selectExpr("id", "id % 3 AS k").createOrReplaceTempView("numbers")
        return ["numbers"]

    return Service(spark, build, {"numbers": "a hundred"})


def test_service_reads(service):
    assert service.list_sources() == [{"name": "numbers", "description": "a hundred"}]
    assert service.describe_table("numbers")["columns"][0]["name"] == "id" and "error" in service.describe_table("x")
    got = service.query_sql("WITH a AS (SELECT k, count(*) AS n FROM numbers GROUP BY k) SELECT * FROM a ORDER BY k")
    assert got["rows"] == [[0, 34], [1, 33], [2, 33]] and not got["truncated"]
    assert service.query_sql("SELECT id FROM numbers", 5)["truncated"] and service.query_sql("SELECT id FROM numbers", 9999)["row_count"] == 100
    assert service.query_sql("SELECT * FROM numbers WHERE id IN (SELECT max(id) FROM numbers)")["rows"] == [[99, 0]]


@pytest.mark.parametrize("sql", ["DROP TABLE numbers", "CREATE TABLE x AS SELECT 1", "INSERT INTO numbers SELECT 1, 2", "SET a=b", "SELECT * FROM parquet.`/etc`", "SELECT * FROM other", "SELECT * FROM numbers WHERE id IN (SELECT id FROM csv.`/etc/passwd`)", "", "SELECT FROM WHERE", "CACHE TABLE numbers", "WITH a AS (SELECT * FROM json.`/x`) SELECT * FROM a", "EXPLAIN SELECT 1"])
def test_service_refuses(service, sql):
    assert "error" in service.query_sql(sql)


def test_service_stops_long_queries(spark, service):
    slow = Service(spark, service.build, timeout="1s")
    assert "stopped" in slow.query_sql("SELECT sum(a.id * b.id * c.id * d.id * e.id % 7) FROM numbers a, numbers b, numbers c, numbers d, numbers e")["error"]


def test_values():
    import datetime
    import decimal

    assert [jsonable(x) for x in (float("nan"), decimal.Decimal("2"), decimal.Decimal("2.5"), b"a", datetime.date(2024, 1, 2), {"a": [None]})] == ["nan", 2, 2.5, "YQ==", "2024-01-02", {"a": [None]}]
    assert [seconds(x) for x in ("500ms", "2m", "3", None)] == [0.5, 120.0, 3.0, 790.0]
    with pytest.raises(ValueError):
        seconds("soon")


def test_microbatches_equal_a_batch(spark, tmp_path):
    src, out, ck = (str(tmp_path / x) for x in ("src", "out", "ck"))
    schema = "id string, v string, t string"
    for i, rows in enumerate(([("a", "1", "x"), ("b", "1", "x")], [("a", "3", "y")], [("a", "2", "late"), ("c", "1", "z")])):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
    target = MergedTable(spark, out, ["id"], "v")
    ingest(spark, src, schema, target, ck, 1).awaitTermination()
    want = [("a", "3", "y"), ("b", "1", "x"), ("c", "1", "z")]
    assert sorted(map(tuple, target.read().collect())) == want
    target.merge(spark.createDataFrame([("z", "9", "again")], schema), 0, stream_id(spark, ck))  # a replayed batch of this stream
    assert sorted(map(tuple, target.read().collect())) == want
    spark.createDataFrame([("b", "5", "new")], schema).coalesce(1).write.mode("append").parquet(src)
    ingest(spark, src, schema, target, ck, 1).awaitTermination()
    assert sorted(map(tuple, target.read().collect())) == [want[0], ("b", "5", "new"), want[2]]


def test_enrichment(spark, tmp_path):
    for name, text in (("C-1_attachment_2_extracted.txt", "two"), ("C-1_attachment_1_extracted.txt", " one \n"), ("C-1_attachment_10_extracted.txt", "ten"), ("C-2_attachment_1_extracted.txt", " ")):
        (tmp_path / name).write_text(text)
    texts = enrich.derived_texts(spark, str(tmp_path))
    assert [tuple(r) for r in texts.collect()] == [("C-1", "one\n\ntwo\n\nten")]
    pdf = '[{"url": "http://x/a.pdf", "format": "pdf"}, {"url": "http://x/b.pdf", "format": "pdf"}]'
    df = spark.createDataFrame([("C-1", pdf, None, None), ("C-2", "[]", None, None), ("C-3", pdf, "t", "ok"), ("C-4", pdf, None, "")], "id string, attachments_json string, text_content string, text_extraction_status string")
    got = {r.id: r for r in enrich.with_derived(df, texts, "id").collect()}
    assert got["C-1"].text_content == "one\n\ntwo\n\nten" and got["C-1"].text_extraction_status == "ok" and got["C-4"].text_content is None and got["C-3"].text_content == "t"
    assert tuple(enrich.stats(enrich.candidates(df, "id"), texts, "id").first()) == (2, 1, 1)
    done = {r.id: r for r in enrich.from_pdfs(df, "id", lambda u: b"%" if "a.pdf" in u else None, lambda b: ("page", "ok")).collect()}
    assert (done["C-1"].text_content, done["C-1"].text_extraction_status) == ("page", "ok") and done["C-2"].text_extraction_status is None and done["C-4"].text_content == "page"
    assert enrich.pdf_text(b"junk")[1] == "error" and enrich.pdf_text(None)[1] == "error"
