from pyspark.sql import functions as F

from tabloom.functions import classify, dates, nested
from tabloom.functions import text as tx


def one(spark, value, kind, expr):
    return spark.createDataFrame([(value,)], f"x {kind}").select(expr.alias("y")).first().y


def test_clean_html_decodes_before_it_strips(spark):
    assert one(spark, "a &lt;b&gt;x&lt;/b&gt;<br/>y &amp; z", "string", tx.clean_html("x")) == "a x y & z"
    assert one(spark, None, "string", tx.clean_html("x")) == ""


def test_cut_references_stay_where_only_whole_ones_count(spark):
    assert one(spark, "<title>a &amp;&amp</title>b &quo &eacute; &#x2014; &bogus; &notit; &copy2", "string", tx.clean_html("x", terminated=True)) == "a &&amp b &quo \xe9 \u2014 &bogus; &notit; &copy2"
    assert one(spark, "a &lt;b&gt; &amp;lt;&amp", "string", tx.clean_html("x", terminated=True)) == "a &lt;&amp"
    assert one(spark, "<title>a &amp;&amp</title>b", "string", tx.clean_html("x")) == "a && b"


def test_the_page_query_keeps_cut_references_and_nulls(spark, tmp_path):
    from tabloom import queries

    spark.createDataFrame([(1, "<title>a&amp;&amp</title>"), (2, None)], "page_id long, html string").write.parquet(f"{tmp_path}/pages.parquet")
    got = dict(map(tuple, queries.queries()["clean_html"](spark, str(tmp_path)).collect()))
    assert got == {1: "a&&amp \xa7\xa7\u2014", 2: None}


def test_ids_and_text(spark):
    assert one(spark, '"EPA-1" ', "string", tx.strip_quotes("x")) == 'EPA-1" '
    assert one(spark, "  The  Clean-Air ACT! ", "string", tx.normalised("x")) == "the clean air act"
    assert one(spark, "The Clean Air Act and Rule of Ozone", "string", tx.informative_tokens("x")) == ["clean", "air", "ozone"]
    assert one(spark, ["b", "a", "b", "a", "b"], "array<string>", tx.shingles("x", 3)) == ["a b a", "b a b"]
    assert one(spark, ["b"], "array<string>", tx.shingles("x", 3)) == []
    assert one(spark, "100% sure_", "string", tx.search_any(["x"], "0% SURE_")) is True
    assert one(spark, None, "string", tx.search_any(["x"], "a")) is False
    assert one(spark, "notice of proposed rulemaking", "string", tx.is_boilerplate("x")) is True
    assert one(spark, True, "boolean", tx.as_text(F.col("x"), "boolean")) == "True"


def test_jaccard(spark):
    df = spark.createDataFrame([(["a", "b"], ["b", "c"]), ([], ["a"])], "a array<string>, b array<string>")
    assert [r[0] for r in df.select(tx.jaccard("a", "b")).collect()] == [1 / 3, 0.0]


def test_dates(spark):
    assert str(one(spark, "2024-06-01T04:00:00Z", "string", dates.day("x"))) == "2024-06-01"
    assert one(spark, "2024", "string", dates.day("x")) is None and one(spark, "2024-13-01", "string", dates.day("x")) is None
    assert str(one(spark, "2024-06-01T23:00:00-05:00", "string", dates.instant("x"))) == "2024-06-01 23:00:00"
    assert one(spark, ["03/00/2024", "1/45/2024", "13/01/2024", "x", "03/01/2024"], "array<string>", dates.us_days("x")) == ["2024-01-31", "2024-03-01"]
    assert one(spark, "Tue, 05 Mar 2024 10:00:00 GMT", "string", dates.rfc822_day("x")) == "2024-03-05"
    assert one(spark, "never", "string", dates.rfc822_day("x")) is None


def test_nested(spark):
    assert one(spark, '["a", "b"]', "string", nested.json_list("x")) == ["a", "b"]
    assert one(spark, "not json", "string", nested.json_list("x")) is None
    assert one(spark, "https://x.org/products/GAO-24-1/", "string", nested.last_segment("x")) == "gao-24-1"
    flat = '[{"url": "http://a/x.PDF", "format": null}, {"url": "http://a/y", "format": "pdf"}, {"url": "http://a/z.doc", "format": "doc"}]'
    assert one(spark, flat, "string", nested.pdf_urls("x")) == ["http://a/x.PDF", "http://a/y"]
    deep = '[{"title": "t", "formats": [{"url": "http://a/x.pdf", "format": "pdf"}, {"url": "http://a/x.pdf", "format": "pdf"}]}]'
    assert one(spark, deep, "string", nested.pdf_urls("x")) == ["http://a/x.pdf"]
    assert one(spark, "junk", "string", nested.pdf_urls("x", F.lit("http://a/own.pdf"))) == ["http://a/own.pdf"]
    df = spark.createDataFrame([([(1, "a"), (2, "b"), (1, "c")],)], "x array<struct<id:int,n:string>>")
    assert [r.n for r in df.select(nested.first_of_each("x", lambda e: e["id"]).alias("y")).first().y] == ["a", "b"]
    assert one(spark, ["error", "empty"], "array<string>", nested.combined_status("x", F.lit(""))) == "error"
    assert one(spark, ["error", "ok"], "array<string>", nested.combined_status("x", F.lit("t"))) == "ok"


def test_classes(spark):
    assert one(spark, "Acme Corporation Association", "string", classify.entity_kind("x")) == "industry"
    assert one(spark, "Jane Doe", "string", classify.entity_kind("x")) == "individual"
    assert one(spark, "I SUPPORT this but oppose that", "string", classify.position("x")) == "mixed"
    assert one(spark, "hm", "string", classify.position("x")) == "neutral/unclear"
    assert [one(spark, n, "int", classify.bucket("x", [100, 500])) for n in (1, 100, 500)] == ["<100", "100-499", "500+"]
