"""Which texts the near-duplicate stage compares."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from tabloom.llm import widehash

from .helpers import EDGE, edge
from .test_matching import slow_classes, texts


def test_unrelated_texts_never_meet(spark, monkeypatch):
    rnd = random.Random(6)
    word = lambda: "".join(rnd.choices("abcdefghij", k=6))
    rows = [(i, " ".join(word() for _ in range(rnd.randint(30, 90)))) for i in range(300)]
    rows += [(1000 + i, t + " more") for i, t in rows[:20]]
    compared, links = [], widehash.links
    monkeypatch.setattr(widehash, "links", lambda fps, *a: compared.append(fps.count()) or links(fps, *a))
    kept = widehash.one_of_each(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(r.doc_id for r in kept.collect()) == list(range(300))
    assert sum(compared) == 0  # nothing is compared with everything; before, all 320 were


@pytest.mark.parametrize("few, frequent, tile, shingles", [(1, 2, 16, 900), (2, 2, widehash.TILE, widehash.TILE_SHINGLES), (3, 10**9, 40, 900)])
def test_classes_are_the_same_however_texts_meet(spark, monkeypatch, few, frequent, tile, shingles):
    rows = list(EDGE) + [(50 + i, t, "z") for i, t in enumerate(texts(150, 12) + texts(60, 5))] + [(None, "one", "z"), (None, "only here", "z")]
    for name, value in (("FEW", few), ("FREQUENT", frequent), ("ONE_IN", 1), ("ENTRIES", 500)):
        monkeypatch.setattr(widehash, name, value)
    monkeypatch.setattr(widehash.links, "__defaults__", (widehash.RADIUS, tile))
    monkeypatch.setattr(widehash.disputes, "__defaults__", (shingles,))
    assert Counter(r.doc_id for r in widehash.one_of_each(edge(spark, rows)).collect()) == slow_classes(rows)


@pytest.mark.parametrize("seed", range(4))
def test_similar_sets_share_one_of_their_first_shingles(seed):
    rng = np.random.default_rng(seed)
    found = 0
    for _ in range(300):
        x = np.unique(rng.integers(0, 1 << 63, rng.integers(1, 40), dtype=np.uint64))
        y = np.unique(np.concatenate([x[rng.random(len(x)) > rng.choice([0.02, 0.1])], rng.integers(0, 1 << 63, rng.integers(0, 5), dtype=np.uint64)]))
        shared = len(np.intersect1d(x, y))
        frequent = np.stack([h := np.unique(np.concatenate([x[rng.random(len(x)) > 0.5], y[rng.random(len(y)) > 0.5]])), rng.integers(1, 5, len(h)).astype(np.uint64)])
        if shared >= 0.8 * (len(x) + len(y) - shared):
            found += 1
            for order in (widehash.NONE, frequent):
                assert len(np.intersect1d(widehash.first(x, order, 0.8), widehash.first(y, order, 0.8)))
    assert found > 50 and not len(widehash.first(np.zeros(0, np.uint64), widehash.NONE, 0.8))


@pytest.mark.parametrize("few", [1, 3, 50])
def test_pairs_under_a_shingle(few):
    rnd = random.Random(few)
    size = {s: rnd.randint(5, 9) for s in range(-10, 30)}
    entries = [(rnd.choice([rnd.randrange(40), 2**64 - 1]), s) for s in size for _ in range(rnd.randint(0, 4))] * 2
    rnd.shuffle(entries)
    groups = defaultdict(set)
    for h, s in entries:
        groups[h].add(s)
    many = {s for g in groups.values() if len(g) > few for s in g}
    pairs = {(a, b) for g in groups.values() if len(g) <= few for a in g for b in g if a < b and min(size[a], size[b]) >= 0.8 * max(size[a], size[b]) - 1e-9}
    h, s = np.array([e[0] for e in entries], np.uint64), np.array([e[1] for e in entries], np.int64)
    u, v, w = widehash.meeting(h, s, np.array([size[x] for x in s.tolist()], np.int64), 0.8, few)
    assert Counter(zip(u.tolist(), v.tolist())) == Counter(pairs) and w.tolist() == sorted(many)
    u, v, w = widehash.meeting(h[:0], s[:0], s[:0], 0.8, few)
    assert not len(u) + len(v) + len(w)
