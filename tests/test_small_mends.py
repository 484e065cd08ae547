"""Character references without Python, floats as text, orders, and pair scores against brute force."""

import html
import math
import random
from difflib import SequenceMatcher

from pyspark.sql import functions as F

from tabloom.functions import text as tx
from tabloom.operators import nearmatch, rollups


def test_references_are_the_full_decoding(spark):
    rnd = random.Random(4)
    parts = ["&amp;", "&lt;", "lt;", "&", "amp;", "&amp", "&#39;", "&#38;", "&#x27;", "&#39", "&nbsp;", "&copy;", "&copy", "&eacute;", "&rsquo;", "&#8217;", "x", " ", ";", "#39;", "&notin;", "&ampx;", "&#", "&#x;", "1"]
    texts = ["".join(rnd.choices(parts, k=rnd.randint(1, 8))) for _ in range(3000)] + [None, ""]
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    got = [r[0] for r in df.select(tx.unescape_html("x")).collect()]
    bad = [(t, g) for t, g in zip(texts, got) if g != (html.unescape(t) if t is not None else None)]
    assert not bad, bad[:5]


def test_floats_are_written_as_python_does(spark):
    rnd = random.Random(8)
    xs = [0.0, -0.0, 1.0, 12.5, 1e7, 12345678.9, 1e15, 1.5e15, 1e16, 1e-3, 1e-4, 1.5e-5, 0.00012345, -2.5e8, float("nan"), float("inf"), float("-inf"), 123456789012345.6, 1e100, None] + [round(rnd.uniform(-1, 1) * 10 ** rnd.randint(-7, 18), rnd.randint(0, 6)) for _ in range(300)]
    got = [r[0] for r in spark.createDataFrame([(x,) for x in xs], "x double").select(tx.as_text(F.col("x"), "double")).collect()]
    want = [None if x is None else str(x) for x in xs]
    same = lambda a, b: a == b or a is not None and float(a) == float(b) and len(a) <= len(b) + 1  # noqa: E731  JDK 17 may write one digit more
    assert got[:20] == want[:20] and all(same(a, b) for a, b in zip(got, want)) and sum(a == b for a, b in zip(got, want)) > 0.9 * len(xs)


def test_orders_of_several_keys(spark):
    a = spark.createDataFrame([("x",), ("y",), ("y",), ("z",), ("w",)], "k string")
    b = spark.createDataFrame([("z",), ("z",), ("x",)], "k string")
    assert [r.k for r in rollups.counts_over({"a": a, "b": b}, "k", ["a", "b"]).collect()] == ["y", "z", "x", "w"]
    df = spark.createDataFrame([("A,B", "2024-01-01"), ("A", "2024-03-01"), ("B, ", None)], "ids string, day string")
    got = rollups.exploded_links(df, F.split("ids", ","), "id", ["day"], [F.desc("day")]).collect()
    assert [(r.id, r.day) for r in got] == [("A", "2024-03-01"), ("A", "2024-01-01"), ("B", "2024-01-01"), ("B", None)]


def test_pairs_are_those_of_brute_force_and_few_go_to_python(spark):
    rnd = random.Random(2)
    words = ["ozone", "national", "emission", "limits", "standards", "foundries", "hazardous", "pollutants", "review", "water", "quality", "permits", "vessels", "coastal", "labeling", "zinc"]
    rows = [(f"r{i:03d}", f"G{i % 5}", " ".join(rnd.sample(words, rnd.randint(5, 8))), f"2024-0{rnd.randint(1, 9)}-1{rnd.randint(0, 9)}") for i in range(90)]
    recs = nearmatch.records(spark.createDataFrame(rows, "id string, g string, t string, m string"), "id", "g", "t", "m")
    pairs = nearmatch.candidates(recs, 1000, 2).cache()
    got = {(r.a, r.b): r.score for r in nearmatch.scored(pairs, recs).collect()}
    by = {r.id: r for r in recs.collect()}
    want, python = {}, 0
    for p in pairs.collect():
        a, b = by[p.a], by[p.b]
        if a.grp == b.grp:
            continue
        ratio = SequenceMatcher(None, a.norm, b.norm).ratio()
        x, y = set(a.words), set(b.words)
        shared = len(x & y) / len(x | y) if x and y else 0.0
        common = sum(min(a.norm.count(c), b.norm.count(c)) for c in set(a.norm))
        python += 2 * common / (len(a.norm) + len(b.norm)) >= 0.65 or shared >= 0.65
        if ratio >= 0.65 or shared >= 0.65:
            gap = abs((a.day - b.day).days)
            bonus = next((x for days, x in nearmatch.GAP_BONUS if gap <= days), 0.0)
            want[p.a, p.b] = min(1.0, 0.5 * ratio + 0.25 * shared + 0.2 * (a.norm == b.norm) + bonus)
    assert got.keys() == want.keys() and all(math.isclose(got[k], want[k], abs_tol=1e-9) for k in got) and len(got) > 10
    bound = spark.createDataFrame([(by[p.a].norm, by[p.b].norm) for p in pairs.collect()], "a string, b string")
    kept = bound.filter(nearmatch.ratio_bound(F.col("a"), F.col("b"), nearmatch.char_counts("a"), nearmatch.char_counts("b")) >= 0.65).count()
    assert kept < pairs.count() and python > 0


def test_downloads_are_left_off_when_too_large(spark):
    from tabloom.operators import enrich

    asked, closed = [], []

    def chunks(n):
        try:
            for _ in range(n):
                asked.append(1)
                yield b"x" * 10
        finally:
            closed.append(1)

    assert enrich.capped(chunks(3), 30) == b"x" * 30 and len(asked) == 3
    assert enrich.capped(chunks(1000), 45) is None and len(asked) == 8 and len(closed) == 2
    assert enrich.capped(None) is None and enrich.capped(b"ab", 1) is None and enrich.capped(b"", 1) == b""
    pdf = '[{"url": "u1", "format": "pdf"}, {"url": "u2", "format": "pdf"}]'
    df = spark.createDataFrame([("C", pdf, None, None)], "id string, attachments_json string, text_content string, text_extraction_status string")
    done = enrich.from_pdfs(df, "id", lambda u: iter([b"a", u.encode()]), lambda b: (b.decode(), "ok")).first()
    assert done.text_content == "au1\n\nau2"
