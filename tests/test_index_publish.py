"""Postings against BM25, cells against exact search, and publishing."""

import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabloom.operators import index, publish, search


@pytest.fixture(scope="module")
def docs(spark):
    rnd = random.Random(3)
    words = [f"w{int(rnd.paretovariate(0.7))}" for _ in range(9000)]
    rows = [(i, " ".join(rnd.sample(words, rnd.randint(1, 60))), 1, "x") for i in range(1500)] + [(5000, None, 1, "x"), (5001, "", 1, "x"), (5002, "w1 " * 3000, 1, "x"), (5003, "Ozone, ozone!", 1, "x")]
    return spark.createDataFrame(rows, "doc_id long, t string, len int, word string").cache()


@pytest.fixture(scope="module")
def postings(docs, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("index") / "p")
    index.build_postings(docs, "doc_id", "t", path, folders=8, range_docs=100)
    return path


@pytest.mark.parametrize("query", ["w1", "w1 w2 w77", "Ozone w3", "ozone", "nothing at all", "w5 w5 W6"])
@pytest.mark.parametrize("limit", [None, 1, 10, 5000])
def test_scores_are_those_of_bm25(spark, docs, postings, query, limit):
    got = index.search_postings(spark, postings, query, limit).collect()
    want = search.bm25(docs, "doc_id", "t", query, limit).collect()
    order = (lambda x: x) if limit else (lambda x: sorted(x, key=lambda r: r[0]))
    assert [r.id for r in order(got)] == [r.doc_id for r in order(want)]
    assert all(abs(a.score - b.score) < 1e-9 for a, b in zip(order(got), order(want)))


def test_a_query_reads_its_words_folders_only(spark, postings):
    spark.conf.set("spark.sql.maxMetadataStringLength", 2000)
    plan = index.search_postings(spark, postings, "ozone", 3)._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    read = [line for line in plan.splitlines() if "FileScan" in line and "docs:" in line]
    assert read and all("PartitionFilters: [isnotnull(folder" in x and "EqualTo(word,ozone)" in x and "ReadSchema: struct<word:string,range:int,docs:array<struct<id:bigint,tf:int,len:int>>>" in x for x in read)
    with pytest.raises(ValueError):
        index.search_postings(spark, postings, " !")


def shuffled(spark):
    """Records that the stages of this session have written to shuffles so far."""
    sc, jvm = spark.sparkContext, spark.sparkContext._jvm
    stages = sc._jsc.sc().statusStore().stageList(None, False, False, sc._gateway.new_array(jvm.double, 0), jvm.java.util.ArrayList())
    return sum(stages.apply(i).shuffleWriteRecords() for i in range(stages.size()))


def test_a_posting_is_dealt_once(spark, docs, tmp_path):
    docs.count()
    before = shuffled(spark)
    index.build_postings(docs, "doc_id", "t", str(tmp_path / "p"), folders=8, range_docs=100)
    made = spark.read.parquet(str(tmp_path / "p" / "postings"))
    postings = made.agg(F.sum("n")).first()[0]
    assert postings <= shuffled(spark) - before <= postings + 100  # and a few rows of counts
    assert made.groupBy("word", "range").count().filter("count > 1").count() == 0


def test_word_counts(spark):
    df = spark.createDataFrame([(["a", "a", "b", "c", "c", "c"],), (["x"],), ([],)], "w array<string>")
    got = [[tuple(x) for x in r[0]] for r in df.select(index.word_counts("w")).collect()]
    assert got == [[("a", 2), ("b", 1), ("c", 3)], [("x", 1)], []]


def test_a_frequent_word_is_written_by_several_tasks(spark, docs, tmp_path, monkeypatch):
    monkeypatch.setattr(index, "TASK_RANGES", 20)
    path = str(tmp_path / "p")
    index.build_postings(docs, "doc_id", "t", path, folders=2, range_docs=10)
    assert spark.read.parquet(f"{path}/postings").filter("word = 'w1'").select(F.input_file_name()).distinct().count() > 1
    got, want = index.search_postings(spark, path, "w1 w2", None).collect(), search.bm25(docs, "doc_id", "t", "w1 w2", None).collect()
    assert {r.id: round(r.score, 9) for r in got} == {r.doc_id: round(r.score, 9) for r in want}


def test_an_empty_table_has_an_index(spark, tmp_path):
    index.build_postings(spark.createDataFrame([], "doc_id long, t string"), "doc_id", "t", str(tmp_path / "e"), folders=2)
    index.build_cells(spark.createDataFrame([(1, None), (2, [0.0, 0.0])], "id long, v array<double>"), "id", "v", str(tmp_path / "c"))
    assert index.search_cells(spark, str(tmp_path / "c"), [1.0, 0.0]).count() == 0


def test_cells_find_nine_of_ten(spark, tmp_path):
    """Recall at 10 against the exact search, for every vector of the test table whose id is divisible by 100, and the exact way kept."""
    e = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    path = str(tmp_path / "cells")
    index.build_cells(e, "vec_id", "embedding", path)
    assert spark.read.parquet(f"{path}/cells").count() == e.count()
    found = asked = 0
    x = {r.vec_id: np.array(r.embedding, float) for r in e.collect()}
    ids = np.array(sorted(x))
    m = np.stack([x[i] / np.linalg.norm(x[i]) for i in ids])
    queries = [i for i in ids.tolist() if i % 100 == 0]
    for i in queries:
        best = set(ids[np.argsort(-(m @ m[np.searchsorted(ids, i)]), kind="stable")[:10]].tolist())
        found += len(best & {r.id for r in index.search_cells(spark, path, x[i].tolist(), 10).collect()})
        asked += 10
    assert found >= 0.9 * asked, found / asked
    exact = index.search_cells(spark, path, x[100].tolist(), 10, probes=1.0).collect()
    want = search.vector_search(e, "vec_id", "embedding", x[100].tolist(), 10).collect()
    assert [(r.id, round(r.score, 9)) for r in exact] == [(r.vec_id, round(r.score, 9)) for r in want]
    few = index.search_cells(spark, path, x[0].tolist(), 10, probes=3)
    assert few.count() == 10 and "cell#" in few._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1].split("]")[0]


def test_clustered_vectors_need_few_cells(spark, tmp_path):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(40, 16))
    rows = [(i, (centres[i % 40] + 0.05 * rng.normal(size=16)).tolist()) for i in range(2000)]
    index.build_cells(spark.createDataFrame(rows, "id long, v array<double>"), "id", "v", str(tmp_path / "c"))
    about = index._load(spark, str(tmp_path / "c" / "centres.json"))
    assert about["probes"] <= len(about["centres"]) / 4
    exact = search.vector_search(spark.createDataFrame(rows, "id long, v array<double>"), "id", "v", rows[7][1], 10).collect()
    assert len({r.id for r in exact} & {r.id for r in index.search_cells(spark, str(tmp_path / "c"), rows[7][1], 10).collect()}) >= 9


def put(root, name, content):
    path = os.path.join(root, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(content)


def published(root):
    return {os.path.relpath(os.path.join(d, f), root): open(os.path.join(d, f), "rb").read() for d, _, names in os.walk(root) for f in names if "/_" not in d and not f.startswith(".")}


def test_only_what_changed_is_copied(spark, tmp_path, monkeypatch):
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    for i in range(6):
        put(a, f"agency=X{i % 2}/part {i}.parquet", b"x" * (100 + i))
    put(a, "top.json", b"{}")
    put(a, "_hidden/no", b"-")
    run = lambda **k: publish.publish(spark, f"file://{a}", f"file://{b}", tasks=3, **k)
    assert run() == {"copied": 7, "kept": 0, "deleted": 0} and len(published(b)) == 7
    times = {f: os.stat(os.path.join(b, f)).st_mtime_ns for f in published(b)}
    assert run() == {"copied": 0, "kept": 7, "deleted": 0}
    put(a, "top.json", b"[]")  # same size, other content
    put(a, "new/file", b"n")
    os.remove(os.path.join(a, "agency=X0/part 0.parquet"))
    assert run() == {"copied": 2, "kept": 5, "deleted": 0} and published(b)["top.json"] == b"[]" and len(published(b)) == 8
    assert all(os.stat(os.path.join(b, f)).st_mtime_ns == t for f, t in times.items() if f != "top.json")
    assert run(delete=True)["deleted"] == 1 and len(published(b)) == 7
    # a run that broke off: some files are copied, the manifest is the old one
    for i in range(4):
        put(a, f"more/{i}", bytes([i]))
    put(b, "more/0", bytes([0]))
    put(b, "more/1", b"half")
    monkeypatch.setattr(publish, "swap", lambda *x: (_ for _ in ()).throw(RuntimeError("gone")))
    with pytest.raises(RuntimeError):
        run()
    monkeypatch.undo()
    assert published(b)["more/1"] == bytes([1])
    assert run() == {"copied": 0, "kept": 11, "deleted": 0} or run()["copied"] == 0
    assert spark.read.parquet(f"{b}/_manifest").filter(F.col("file").startswith("more/")).count() == 4
    for f in list(published(a)):
        if not f.startswith("more"):
            os.remove(os.path.join(a, f))
    with pytest.raises(ValueError):
        run(delete=True)
