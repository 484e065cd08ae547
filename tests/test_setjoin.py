"""Set-similarity classes against brute force."""

import random
import re

import pytest

from tabloom.operators import setjoin

SCHEMA = "doc_id long, text string, row int, n string, k long"


def brute(rows, t=0.8, k=5):
    def shingles(text):
        w = re.sub("[^a-z0-9]+", " ", (text or "").lower()).split()
        return frozenset([tuple(w)] if 0 < len(w) < k else [tuple(w[i : i + k]) for i in range(len(w) - k + 1)])

    docs = [(i, shingles(x)) for i, x in rows]
    sets = list({s for _, s in docs if s})
    root = list(range(len(sets)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both >= t * (len(a) + len(sets[j]) - both) - 1e-9:
                root[find(i)] = find(j)
    least = lambda of: min((x for x, s in docs if s and x is not None and of(s)), default=None)
    place = {s: find(i) for i, s in enumerate(sets)}
    out = [(i, least(lambda s, own=s: s == own) if s else i, least(lambda s, own=s: place[s] == place[own]) if s else i, len(s)) for i, s in docs]
    return sorted(out, key=str)


def got(spark, rows, **k):
    df = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA)
    return sorted(map(tuple, setjoin.classes(df, "doc_id", "text", **k).collect()), key=str)


def corpus(seed):
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choices("abcde", k=rnd.randint(1, 4)))
    prose = lambda n: [word() for _ in range(n)]
    passage, rows = prose(60), []
    for _ in range(12):  # near copies of near copies, and a passage that many share
        base = prose(rnd.choice([8, 30, 120]))
        for _ in range(rnd.randint(1, 9)):
            rows.append(base := [word() if rnd.random() < 0.02 else w for w in base])
        rows.append(prose(rnd.randint(1, 20)) + passage)
        rows.append(passage + prose(rnd.randint(1, 6)))
    return [(i, " ".join(w)) for i, w in enumerate(rows)]


EDGE = [(1, None), (2, ""), (3, " .. "), (4, "one"), (5, "One!"), (5, "one"), (None, "one two"), (None, "one, two"), (6, "a b c d e"), (7, "A-B-C-D-E"), (8, "a b c d e f"), (9, "w " * 5000), (10, "w w w w w"), (None, None), (11, "é é é")]


@pytest.mark.parametrize("rows", [corpus(1), corpus(2), EDGE, []], ids=["a", "b", "edge", "empty"])
def test_classes_are_the_brute_force_ones(spark, rows):
    assert got(spark, rows) == brute(rows)


@pytest.mark.parametrize("how", [{"similarity": 0.6}, {"similarity": 1.0}, {"words": 1, "rounds": 0}, {"k": 2, "rounds": 1}])
def test_other_thresholds_and_orders(spark, how):
    rows = corpus(3)
    assert got(spark, rows, **how) == brute(rows, how.get("similarity", 0.8), how.get("k", 5))


def test_a_group_of_near_copies_never_becomes_all_its_pairs(spark, monkeypatch):
    rnd = random.Random(6)
    base = [str(i) for i in range(200)]
    rows = []
    for i in range(400):
        w = list(base)
        w[rnd.randrange(200)] = f"own{i}"
        rows.append((i, " ".join(w)))
    compared, real = [], setjoin._verified

    def counted(pairs, *how):
        compared.append(pairs.count())
        return real(pairs, *how)

    monkeypatch.setattr(setjoin, "_verified", counted)
    assert {r[2] for r in got(spark, rows)} == {0} and sum(compared) < 4 * len(rows)


def test_shingles_are_the_distinct_windows_of_a_text(spark):
    words = [random.Random(9).choice("abc") for _ in range(300)]
    texts = [" ".join(words), "a b c d e", "A-b c d, e", "a b c d", "a b c", "a b d c e", "b a", "a b", "a b a b a b a b", " .. ", None]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "i int, text string")
    got = dict(map(tuple, df.select("i", setjoin.shingle_hashes("text")).collect()))
    assert all(s == sorted(set(s)) and all(0 <= h < 1 << 62 for h in s) for s in got.values())
    assert len(got[0]) == len({tuple(words[i : i + 5]) for i in range(296)}) and set(got[1]) == set(got[2])
    assert [len(got[i]) for i in range(1, 11)] == [1, 1, 1, 1, 1, 1, 1, 2, 0, 0]
    assert len({got[i][0] for i in (1, 3, 4, 5, 6, 7)}) == 6


def test_no_row_carries_the_bitmap(spark, monkeypatch):
    plans, real = [], setjoin.materialise

    def seen(df, name):
        if name == "prefixes":
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        return real(df, name)

    monkeypatch.setattr(setjoin, "materialise", seen)
    got(spark, [(1, "a b c d e f"), (2, "a b c d e g")])
    assert len(plans) == 1 and "Join" not in plans[0] and "ArrowEvalPython" in plans[0]
