import itertools
import random

import numpy as np
import pytest

from tabloom.llm import langid, toxicity

from .helpers import EDGE, edge, empty


def brute_marginals(e, first, start, trans):
    """By summing over all labellings, sequence by sequence."""
    k = e.shape[1]
    out, cuts = np.zeros_like(e, float), [*np.flatnonzero(first), len(e)]
    for a, b in zip(cuts, cuts[1:]):
        for path in itertools.product(range(k), repeat=b - a):
            s = start[path[0]] + sum(e[a + i, y] for i, y in enumerate(path)) + sum(trans[x, y] for x, y in zip(path, path[1:]))
            for i, y in enumerate(path):
                out[a + i, y] += np.exp(s)
    return out / out.sum(axis=1, keepdims=True)


@pytest.mark.parametrize("seed", range(5))
def test_forward_backward_is_exact(seed):
    rng = np.random.default_rng(seed)
    n, k = int(rng.integers(1, 30)), int(rng.integers(1, 4))
    first = rng.random(n) < 0.3
    first[0] = True
    for i in range(n):  # keeps the brute force short
        if i >= 6 and not first[i - 5 : i + 1].any():
            first[i] = True
    crf = langid.Crf(tuple("abc"[:k]), np.zeros((1, k)), rng.normal(size=k), rng.normal(size=(k, k)))
    e = rng.normal(size=(n, k)) * 2
    assert np.allclose(crf._by_sequence(e, first), brute_marginals(e, first, crf.start, crf.transitions))
    assert np.allclose(crf.marginals(e, first), brute_marginals(e, first, crf.start, crf.transitions))


def test_word_features():
    a, b = langid.feature_ids(["straße", "x" * 24]), langid.feature_ids(["straße"])
    assert set(a[0]) - {langid.BUCKETS} == set(b[0]) - {langid.BUCKETS} and len(set(b[0])) == 1 + 3 + 4 + 7 + 6


@pytest.mark.parametrize("text, words", [("² ½ Ⅳ ① 12 _", []), ("a½b x²", ["a", "b", "x"]), ("l" * 60, ["l" * 24, "l" * 24, "l" * 12]), ("一二 ｑ ª", ["一二", "ｑ", "ª"]), ("", [])])
def test_words_are_runs_of_letters(text, words):
    assert langid.letter_runs(text) == words and all(w.isalpha() for w in words)


def test_scores_are_those_of_plain_forward_backward(spark):
    rng = np.random.default_rng(3)
    crf = langid.Crf(("aa", "bb", "cc"), np.vstack([rng.normal(size=(langid.BUCKETS, 3)), np.zeros((1, 3))]).astype(np.float32), rng.normal(size=3), rng.normal(size=(3, 3)))
    rows = [(1, "one two three four"), (2, "½ ²"), (3, None), (4, "x"), (None, "five six"), (5, "a" * 50 + " b"), (5, "Ein Wort")]
    got = sorted(((r.doc_id or 0, r.lang_pred, round(r.score, 6)) for r in langid.identify(spark.createDataFrame(rows, "doc_id long, text string"), crf).collect()))
    want = []
    for i, t in rows:
        ws = [w[k : k + 24] for w in "".join(c if c.isalpha() else " " for c in (t or "").lower()).split() for k in range(0, len(w), 24)]
        if ws:
            e = np.stack([crf.weights[langid.feature_ids([w])[0]].sum(axis=0) for w in ws])
            m = brute_marginals(e.astype(float), np.arange(len(ws)) == 0, crf.start, crf.transitions).mean(axis=0)
        want.append((i or 0, crf.languages[m.argmax()], round(m.max(), 6)) if ws else (i or 0, "und", 0.0))
    assert got == sorted(want)


def test_every_language_is_learned_from_one_scan(spark):
    rows = [(i, f"word{i} same", f"l{i % 30:02d}") for i in range(350)] + [(7000, "repeated text", "l01")] * 2000
    crf = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert len(crf.languages) >= 29


def corpus(n, seed=5):
    rng = random.Random(seed)
    parts = {"aa": ["the", "ing", "sh", "wor", "th"], "bb": ["über", "sch", "keit", "und", "ver"], "cc": ["ción", "que", "lla", "os", "ñe"]}
    rows = []
    for i in range(n):
        lang = rng.choice(sorted(parts))
        rows.append((i, " ".join("".join(rng.choices(parts[lang], k=rng.randint(1, 3))) for _ in range(rng.randint(3, 60))), lang))
    return rows


def test_held_out_accuracy(spark):
    rows = corpus(500)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    crf = langid.fit(docs)
    got = {r.doc_id: r for r in langid.identify(docs, crf).collect()}
    import zlib

    held = [i for i, _, _ in rows if zlib.crc32(str(i).encode()) % 4 == 2]
    assert {i for i, r in got.items() if r.held_out} == set(held) and len(held) > 80
    assert sum(got[i].lang_pred == rows[i][2] for i in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in got.values())
    # words of a code-switched text are labelled one by one, and neighbours help
    words = "shwor thing worth schkeit verund überund".split()
    p = crf.marginals(crf.emissions(words), np.arange(6) == 0)
    assert [crf.languages[j] for j in p.argmax(axis=1)] == ["aa"] * 3 + ["bb"] * 3
    assert crf.transitions.diagonal().min() > crf.transitions[~np.eye(3, dtype=bool)].max()
    seen = langid.identify(edge(spark), crf).collect()
    assert len(seen) == len(EDGE) and {r.lang_pred for r in seen if r.doc_id in (1, 2, 3)} == {"und"} and all(r.score == 0 for r in seen if r.doc_id in (1, 2, 3))
    assert langid.identify(empty(spark), crf).count() == 0


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "some words", None), (None, "some words", "aa"), (2, None, "bb")], "doc_id long, text string, lang string")
    crf = langid.fit(docs)
    assert [(r.lang_pred, r.score) for r in langid.identify(docs, crf).collect()] == [("und", 0.0)] * 3


def test_held_out_rows_are_not_learned(spark):
    docs = spark.createDataFrame(corpus(120), "doc_id long, text string, lang string")
    changed = docs.selectExpr("doc_id", "CASE WHEN crc32(string(doc_id)) % 4 = 2 THEN 'zz zz' ELSE text END AS text", "CASE WHEN crc32(string(doc_id)) % 4 = 2 THEN 'zz' ELSE lang END AS lang")
    a, b = langid.fit(docs), langid.fit(changed)
    assert a.languages == b.languages and np.array_equal(a.weights, b.weights)


def toxic_corpus(n, seed=2):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        words = ["".join(rng.choices(["an", "er", "on", "re", "th"], k=2)) for _ in range(rng.randint(20, 80))]
        toxic = rng.random() < 0.25
        if toxic:
            for _ in range(rng.choice([2, 6, 15])):
                words[rng.randrange(len(words))] = rng.choice(["moron", "scum", "trashly", "trashed"])
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return rows, labels


def test_toxic_texts_are_found(spark):
    rows, labels = toxic_corpus(900)
    docs, known = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels[:600] + [(5000, 1), (3, None), (None, 1)], "doc_id long, toxic int")
    model = toxicity.fit(docs, known)
    got = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    truth = dict(labels)
    rest = [i for i in range(600, 900)]
    assert sum(got[i].toxic == bool(truth[i]) for i in rest) >= 0.97 * len(rest)
    mild, severe = (spark.createDataFrame([(1, " ".join(["moron"] * k + ["aner"] * (60 - k)))], "doc_id long, text string") for k in (2, 25))
    a, b = (toxicity.score(d, model).first() for d in (mild, severe))
    assert a.expected_severity < b.expected_severity <= 3 and b.grade == 3 and b.toxic
    kept = toxicity.clean(edge(spark, [(i, t, "s") for i, t in rows]), model)
    assert kept.columns == edge(spark).columns and {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if not r.toxic}
    seen = toxicity.score(edge(spark), model).collect()
    assert len(seen) == len(EDGE) and not any(r.toxic for r in seen) and toxicity.score(empty(spark), model).count() == 0 and toxicity.clean(empty(spark), model).count() == 0


def test_scores_follow_their_definition(spark):
    chosen = {"w moron": True, "4 moro": True, "5 moron": False, "4 tras": False}
    w, theta = np.array([0.7, -0.2, 0.4, 0.9, 1.3, 0.5]), np.array([0.5, 1.5, 3.0])
    model = toxicity.Model(tuple(chosen), tuple(chosen.values()), w, theta)
    texts = {1: "Moron, moron! a TRASHED thing", 2: "morose trash", 3: "fine words", 4: None, 5: "", 6: "moron " * 5000}
    got = {r.doc_id: r for r in toxicity.score(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), model).collect()}
    for i, t in texts.items():
        words = "".join(c if c.isalpha() else " " for c in (t or "").lower()).split()
        n = [sum(x == "moron" for x in words), sum(x[:4] == "moro" for x in words), sum(x[:5] == "moron" for x in words), sum(x[:4] == "tras" for x in words)]
        telling, other = n[1], n[3]  # every word with a telling feature begins with moro
        z = sum(a * np.log1p(b) for a, b in zip(w, [*n, telling, other]))
        upto = [1 / (1 + np.exp(z - t)) for t in theta]
        p = np.diff([0, *upto, 1])
        assert got[i].grade == int(p.argmax()) and abs(got[i].expected_severity - p @ np.arange(4)) < 1e-9 and abs(got[i].p_toxic - (1 - p[0])) < 1e-9


def test_repeated_ids_count_once_in_the_sample(spark):
    rows, labels = toxic_corpus(300)
    y = spark.createDataFrame(labels, "doc_id long, toxic int")
    one = toxicity.fit(spark.createDataFrame(rows, "doc_id long, text string"), y)
    many = toxicity.fit(spark.createDataFrame(rows + rows[:3] * 200, "doc_id long, text string"), y)
    assert one.features == many.features and np.allclose(one.weights, many.weights)


def test_one_class_finds_nothing(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, "scum")], "doc_id long, text string")
    model = toxicity.fit(docs, spark.createDataFrame([(1, 0), (2, 0)], "doc_id long, toxic int"))
    assert not any(r.toxic for r in toxicity.score(docs, model).collect())


def test_ordinal_fit_recovers_order():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 3))
    z = x @ np.array([2.0, -1.0, 0.0]) + rng.logistic(size=3000)
    y = np.digitize(z, [-1.0, 0.5, 2.0])
    w, theta = toxicity.fit_ordinal(x, y, np.ones(3000), 4, l2=0.1, steps=800)
    assert np.allclose(w, [2, -1, 0], atol=0.25) and np.allclose(theta, [-1, 0.5, 2], atol=0.25) and (np.diff(theta) > 0).all()
