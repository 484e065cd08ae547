"""Crashes between steps, refusals, and listings of odd shapes."""

import datetime as dt
import gzip
import html
import json
import zipfile

import pytest

from tabloom.functions import text as tx
from tabloom.operators import governance, layout, nearmatch, rollups
from tabloom.plans.service import Service
from tabloom.session import discard, materialise
from tabloom.sources import paged, readers


@pytest.mark.parametrize("sql", [
    "SELECT reflect('java.lang.System', 'getenv', 'PATH')", "SELECT java_method('java.lang.System', 'getProperty', 'user.home')", "SELECT try_reflect('java.lang.System', 'getenv', 'PATH')",
    "SELECT id FROM numbers WHERE reflect('java.lang.System', 'getenv', 'PATH') <> ''", "SELECT transform(array(1), x -> reflect('java.lang.System', 'getenv', 'PATH'))",
    "WITH a AS (SELECT java_method('java.lang.System', 'getenv', 'PATH') AS p FROM numbers) SELECT * FROM a", "SELECT (SELECT max(reflect('java.lang.System', 'getenv', 'PATH')) FROM numbers)",
    "SELECT * FROM numbers ORDER BY reflect('java.lang.System', 'getenv', 'PATH')", "SELECT input_file_name() FROM numbers", "SELECT current_user()", "SELECT version()", "SELECT secret(id) FROM numbers",
])
def test_functions_that_reach_out_are_refused(spark, sql):
    def build(session):
        session.range(3).createOrReplaceTempView("numbers")
        session.udf.register("secret", lambda x: str(x))
        return ["numbers"]

    service = Service(spark, build)
    assert "allowed" in service.query_sql(sql)["error"]


def test_functions_that_compute_are_allowed(spark):
    service = Service(spark, lambda s: (s.range(3).createOrReplaceTempView("numbers"), ["numbers"])[1])
    sql = "SELECT id, upper('a') AS u, transform(array(id), x -> x + 1)[0] AS n, row_number() OVER (ORDER BY id) AS r, date_add(DATE '2024-01-01', 1) AS d, coalesce(NULL, round(1.25, 1)) AS c FROM numbers LATERAL VIEW explode(array(1)) e AS k WHERE id BETWEEN 1 AND 2 AND lower('X') LIKE 'x%' ORDER BY id"
    assert [r[:4] for r in service.query_sql(sql)["rows"]] == [[1, "A", 2, 1], [2, "A", 3, 2]]


def test_the_floor_of_lifecycles_is_of_the_earliest_proposal(spark):
    d = dt.date
    proposed = spark.createDataFrame([("a", "X", "t2", d(2005, 1, 1)), ("a", "X", "t1", d(2012, 1, 1)), ("b", "X", None, d(2012, 1, 1))], "k string, g string, title string, day date")
    final = spark.createDataFrame([("a", d(2013, 1, 1)), ("b", None)], "k string, day date")
    assert rollups.lifecycles(proposed, final, "k", "g", "day").count() == 0  # b has a final, though without a date
    assert [(r.k, r.title, r.kind) for r in rollups.lifecycles(proposed, final.filter("k = 'a'"), "k", "g", "day", title="title").collect()] == [("b", None, "stuck")]


def test_pairs_keep_or_miss_the_floors(spark):
    t = "National Emission Limits for Hazardous Air Pollutants in Foundries"
    other = "completely different words about another matter with nothing in common zzz qqq"
    recs = nearmatch.records(spark.createDataFrame([
        ("1", "A", t, "controls of air at foundries"), ("2", "B", t + " Update One", other),  # near titles, abstracts far apart: goes
        ("3", "C", t, "controls of air at foundries"), ("4", "D", "Foundries in Pollutants Air Hazardous for Limits Emission National", None),  # words alike, titles not: stays
    ], "id string, a string, t string, b string"), "id", "a", "t", abstract="b")
    pairs = spark.createDataFrame([("1", "2"), ("1", "3"), ("1", "4"), ("2", "3")], "a string, b string")
    found = {(r.a, r.b): r for r in nearmatch.scored(pairs, recs).collect()}
    from difflib import SequenceMatcher

    far = SequenceMatcher(None, "controls of air at foundries", other).ratio()
    assert ((("1", "2") in found) == (far >= 0.25 or far == 0)) and ("1", "3") in found and ("1", "4") in found and found["1", "4"].title < 0.65


def test_character_references_are_decoded_in_full(spark):
    texts = ["caf&eacute; &#8217;&#167;&sect; &ngE; &#x1F600; &amp;lt; &notanentity; & &copy 5", "no reference", None, "&lt;p&gt;"]
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    assert [r[0] for r in df.select(tx.unescape_html("x")).collect()] == [t and html.unescape(t) for t in texts]


def test_dumps_of_any_layout(spark, tmp_path):
    a, b, c = ({"ueiSAM": x, "n": {"k": [1, None]}} for x in "abc")
    (tmp_path / "one.json").write_text(json.dumps([a, b], indent=2))
    (tmp_path / "two.json").write_text(json.dumps({"totalRecords": 1, "entityData": [c]}, indent=1))
    (tmp_path / "three.json").write_text(json.dumps([a, c]))
    (tmp_path / "four.json").write_text(json.dumps({"entityData": [b]}))
    (tmp_path / "five.ndjson").write_text(json.dumps(a) + "\n\n" + json.dumps(b) + "\n")
    (tmp_path / "six.json.gz").write_bytes(gzip.compress(json.dumps([c], indent=3).encode()))
    (tmp_path / "seven.ndjson").write_text(json.dumps(a) + "\nnot json\n" + json.dumps(c))
    with zipfile.ZipFile(tmp_path / "eight.zip", "w") as z:
        z.writestr("x.json", json.dumps({"entityData": [a, b]}, indent=1))
    (tmp_path / "nine.zip").write_bytes(b"PK broken")
    found = sorted(json.loads(r.value)["ueiSAM"] for r in readers.dump(spark, str(tmp_path)).collect())
    assert found == sorted("ab" "c" "ac" "b" "ab" "c" "ac" "ab")


def test_feeds_with_a_doctype_are_refused(spark, tmp_path):
    item = "<rss><channel><item><title>T</title></item></channel></rss>"
    (tmp_path / "good.xml").write_text(item)
    (tmp_path / "bad.xml").write_text('<?xml version="1.0"?>\n<!doctype rss [<!ENTITY x "y">]>' + item)
    assert [r.title for r in readers.feed(spark, str(tmp_path / "good.xml"), "item", "title string").collect()] == ["T"]
    assert readers.feed(spark, str(tmp_path / "bad.xml"), "item", "title string").count() == 0


def test_cursors_early_stops_and_nested_listings(spark):
    def fetch(since, until, page):
        at = 0 if page == 0 else int(page.removeprefix("after-"))
        return [{"k": str(9 - at - i)} for i in range(3)], f"after-{at + 3}" if at + 3 < 9 else False, None

    days = readers.day_windows(spark, "2024-01-01", "2024-01-01", 1)
    assert sorted(r.k for r in paged.read(spark, fetch, days, "k string", "k").collect()) == list("123456789")
    stop = paged.Policy(enough=lambda r: int(r["k"]) < 6)
    assert sorted(r.k for r in paged.read(spark, fetch, days, "k string", "k", stop).collect()) == list("6789")

    def children(parent, page):
        rows = [{"part": f"{parent['id']}-{page}"}] if parent["n"] else []
        return rows, page + 1 < parent["n"]

    parents = spark.createDataFrame([("x", 2, "d1"), ("y", 0, "d2"), ("z", 1, None)], "id string, n int, day string")
    found = paged.nested(parents, children, "part string, missing int", ["id", "day"])
    assert sorted((r.id, r.day or "", r.part, r.missing) for r in found.collect()) == [("x", "d1", "x-0", None), ("x", "d1", "x-1", None), ("z", "", "z-0", None)]


def test_seeding_goes_on_where_it_stopped(spark, tmp_path, monkeypatch):
    src, out, ledger, index = (str(tmp_path / x) for x in ("src", "out", "ledger", "index"))
    spark.createDataFrame([("1", "A"), ("2", "B")], "id string, agency string").write.parquet(f"{src}/old")
    spark.createDataFrame([("3", "C", "m"), ("4", "A", "m")], "id string, agency string, more string").write.parquet(f"{src}/new")
    real, seen = layout.write_partitioned, []

    def fails_on_b(df, path, by, *a):
        seen.append(df.first().agency)
        if seen == ["A", "B"]:
            raise RuntimeError("gone")
        return real(df, path, by, *a)

    monkeypatch.setattr(layout, "write_partitioned", fails_on_b)
    with pytest.raises(RuntimeError):
        layout.seed_partitions(spark, src, out, ["id", "agency", "more"], "agency", ledger)
    assert layout.seed_partitions(spark, src, out, ["id", "agency", "more"], "agency", ledger) == ["B", "C"]
    assert sorted((r.id, r.agency, r.more) for r in spark.read.parquet(out).collect()) == [("1", "A", None), ("2", "B", None), ("3", "C", "m"), ("4", "A", "m")]
    monkeypatch.undo()
    staged = spark.createDataFrame([("4", "A", "new"), ("5", "A", "x")], "id string, agency string, more string")
    assert layout.merge_and_index(staged, out, index, ["agency"], ["id"], "more") == [{"agency": "A", "row_count": 3}]
    assert [tuple(r) for r in spark.read.parquet(index).collect()] == [("A", 3)] and spark.read.parquet(out).count() == 5


def test_many_partitions_are_merged_by_a_join(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(layout, "MOST_PREDICATES", 2)
    out = str(tmp_path / "t")
    rows = lambda v, ks: spark.createDataFrame([(f"i{k}", k, v) for k in ks], "id string, k int, v string")
    layout.merge_partitions(rows("1", range(6)), out, ["k"], ["id"], "v")
    assert sorted(r["k"] for r in layout.merge_partitions(rows("2", range(3, 8)), out, ["k"], ["id"], "v")) == [3, 4, 5, 6, 7]
    assert sorted((r.id, r.v) for r in spark.read.parquet(out).collect()) == [(f"i{k}", "1" if k < 3 else "2") for k in range(8)]


def test_tables_are_deduplicated_and_counts_remembered(spark, tmp_path):
    path, state = str(tmp_path / "t"), str(tmp_path / "state")
    spark.createDataFrame([("a", "1"), ("a", "2"), ("b", "1"), (None, "1"), (None, "1")], "k string, v string").write.parquet(path)
    assert layout.dedupe_table(spark, path, "k", "v")["excess"] == 1 and spark.read.parquet(path).count() == 5
    assert layout.dedupe_table(spark, path, "k", "v", apply=True)["rows_after"] == 4
    assert sorted((r.k or "", r.v) for r in spark.read.parquet(path).collect()) == [("", "1"), ("", "1"), ("a", "2"), ("b", "1")]
    count = lambda **n: {r.table_name: r.ok for r in governance.checked_counts(spark.createDataFrame(list(n.items()), "table_name string, row_count long"), state).collect()}
    assert count(x=100, y=10) == {"x": True, "y": True} and count(x=40, y=11) == {"x": False, "y": True} and count(x=60) == {"x": True}
    assert {r.table_name: r.row_count for r in spark.read.parquet(state).collect()} == {"x": 60, "y": 11}


def test_statistics_and_organizations(spark):
    a = spark.createDataFrame([("EPA",), ("EPA",), ("FDA",), (None,)], "agency string")
    assert tuple(rollups.dataset_statistics({"comments": a, "dockets": a.limit(1)}, "comments", "agency").first()) == (4, 1, "EPA", 2)
    none = rollups.dataset_statistics({"comments": a.filter("false")}, "comments", "agency").first()
    assert tuple(none) == (0, None, None)
    rows = [(t, f"d{i}") for t, n in (("Sierra Club", 3), ("Comment from X", 5), ("Anonymous one", 5), ("Short", 5), ("Other Group", 2)) for i in range(n)] + [("Sierra Club", "d0")]
    found = rollups.organizations(spark.createDataFrame(rows, "title string, docket string"), "title", "docket", 2)
    assert [tuple(r) for r in found.collect()] == [("Sierra Club", 4, 3)]


def test_intermediates_are_discarded(spark):
    before = materialise(spark.range(3), "x")
    path = before.inputFiles()[0]
    assert discard(spark) >= 1 and discard(spark) == 0
    import os

    assert not os.path.exists(path.removeprefix("file://"))
