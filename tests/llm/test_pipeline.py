"""The pipeline against plain Python, stage by stage, on a small corpus."""

import random
import re
from collections import Counter

import pytest

from tabloom.llm import toxicity

pipeline = pytest.importorskip("corpus_pipeline")


def corpus():
    rng = random.Random(11)
    stop = "the of and to a in is that it for".split()
    word = lambda: "".join(rng.choices(["an", "er", "on", "re", "th", "st", "le"], k=rng.randint(2, 4)))
    text = lambda n: " ".join(rng.choice(stop) if rng.random() < 0.3 else word() for _ in range(n))
    bench = [text(n) for n in (20, 30, 40)]
    docs, labels = [], []
    for i in range(220):
        t = text(rng.choice([40, 120, 400]))
        kind = i % 10
        if kind == 1:
            t = " ".join(w + "###" for w in t.split())
        elif kind == 2:
            w = t.split()
            for _ in range(8):
                w[rng.randrange(len(w))] = "moron"
            t = " ".join(w)
        elif kind == 3 and docs:
            t = docs[rng.randrange(len(docs))][1]
        elif kind == 4:
            t = t + "\n" + rng.choice(bench).upper() + "\n" + text(15)
        elif kind == 5:
            t = "too short"
        docs.append((i, t, "en", f"s{i % 3}", len(t)))
        labels.append((i, 1, int("moron" in t)))
    return docs, labels, bench


def test_pipeline_matches_plain_python(spark, tmp_path):
    docs, labels, bench = corpus()
    put = lambda rows, ddl, name: spark.createDataFrame(rows, ddl).coalesce(2).write.parquet(f"{tmp_path}/{name}.parquet")
    put(docs, "doc_id long, text string, lang string, source string, n_chars long", "documents")
    put(labels, "doc_id long, quality int, toxic int", "labels")
    put(list(enumerate(bench)), "item_id long, text string", "benchmark")
    assert [n for n, _ in pipeline.STAGES] == ["quality_rules", "toxicity", "near_duplicates", "decontamination", "packing"]

    at, kept = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for k, (name, stage) in enumerate(pipeline.STAGES):
        out = stage(spark, at, str(tmp_path))
        if k < 4:
            assert out.columns == at.columns and out.schema.simpleString() == at.schema.simpleString()
        out.write.parquet(f"{tmp_path}/{name}")
        at = spark.read.parquet(f"{tmp_path}/{name}")
        kept[name] = at.collect()

    of = {d[0]: d[1] for d in docs}
    good = {i for i, t in of.items() if len(t.split()) >= 20 and "#" not in t}
    assert {r.doc_id for r in kept["quality_rules"]} == good and all(r.text == of[r.doc_id] for r in kept["quality_rules"])
    polite = {i for i in good if "moron" not in of[i]}
    assert {r.doc_id for r in kept["toxicity"]} == polite
    left = sorted(polite)
    sets = {i: {tuple(w[k : k + 5]) for k in range(len(w) - 4)} for i in left for w in [of[i].lower().split()]}
    root = {i: i for i in left}
    for i in left:
        for j in left:
            if j < i and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                a, b = root[i], root[j]
                root = {x: min(a, b) if r in (a, b) else r for x, r in root.items()}
    single = set(root.values())
    assert {r.doc_id for r in kept["near_duplicates"]} == single
    squeeze = lambda t: " " + " ".join(re.findall(r"[^\W_]+", t.lower())) + " "
    clean = {i for i in single if not any(squeeze(b) in squeeze(of[i]) for b in bench)}
    assert {r.doc_id for r in kept["decontamination"]} == clean and len(clean) < len(single) < len(polite) < len(good)
    bins = Counter()
    for r in kept["packing"]:
        bins[r.sequence_id] += r.length
    assert {r.doc_id for r in kept["packing"]} == clean and max(bins.values()) <= 1024
    again = pipeline.run(spark, str(tmp_path))
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, kept["packing"]))


def test_a_model_is_fitted_on_what_is_there(spark, tmp_path):
    docs, labels, _ = corpus()
    d, y = spark.createDataFrame([x[:2] for x in docs], "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    assert len(toxicity.fit(d, y, sample_rows=10).features) <= toxicity.MAX_FEATURES and toxicity.fit(d.filter("false"), y).features == ()
