import random
import re
from collections import Counter

from tabloom.llm import licenses, quality

from .helpers import EDGE, edge, empty

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    t = text or ""
    w = WORD.findall(t)
    count = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    covered = {i + j for i in range(len(w) - 7) if count[tuple(w[i : i + 8])] > 1 for j in range(8)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), sum(t.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered)


def test_measures(spark):
    random.seed(3)
    rows = list(EDGE) + [(100 + i, " ".join(random.choice("abc") + random.choice(["", "\n", "#"]) for _ in range(random.choice([7, 8, 9, 60, 300]))), "z") for i in range(40)]
    rows += [(200, "same line here\nsame line here\n \nsame line here ", "z")]
    got = quality.quality(edge(spark, rows)).collect()
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got) == Counter((d, *brute(t)) for d, t, _ in rows)
    for r in got:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert not (r.base_failed and r.kept)
    assert quality.quality(empty(spark)).count() == 0


def test_rules(spark):
    clean = " ".join(f"the cat {i} of house {i * 7} and street" for i in range(30))
    rows = [(1, clean, "s"), (2, clean.replace(" ", "### "), "s"), (3, " ".join(f"zzz{i}" for i in range(200)), "s"), (4, "\n".join(f"w{i} the" if i % 3 else "again and again" for i in range(120)), "s"), (5, "\n".join(f"w{i}" if i % 2 else "the" for i in range(200)), "s")]
    got = {r.doc_id: r for r in quality.quality(edge(spark, rows)).collect()}
    assert got[1].kept and got[1].failed_rules == []
    assert got[2].failed_rules == ["symbols_per_word", "stop_words_per_word"] and got[3].failed_rules == ["stop_words_per_word"]
    assert "words_per_line" in got[5].failed_rules
    kept = quality.keep(edge(spark, rows + list(EDGE)))
    assert kept.columns == edge(spark).columns and {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if r.kept}


SPLIT = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def base(text):
    w = SPLIT.findall((text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
    places, labels = [], set()
    for phrase, label in licenses.BASE:
        p = phrase.split()
        for i in range(len(w)):
            if w[i : i + len(p)] == p:
                places.append(i)
                labels.add(label)
    return len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def test_licenses(spark):
    texts = [
        "Released UNDER the MIT-License. Under the MIT License", "Apache License, Version 2.0", "cc by nc cc by-nc 4.0", "ÉCC by nc",
        "Some text. This work is licensed under the GNU General Public License, version 3.\nMore.", "licensed under the GNU General Public License version 9",
        "/* Permission is hereby granted, free of charge, to any person\n * obtaining a copy of this software and associated documentation files */",
        "Permission is hereby granted to you", "under the mit", "mit license under the mit license " * 500,
    ]
    rows = list(EDGE) + [(300 + i, t, "z") for i, t in enumerate(texts)]
    got = licenses.scan(edge(spark, rows)).collect()
    assert Counter((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got) == Counter((d, *base(t)) for d, t, _ in rows)
    labels = {r.doc_id: (r.labels, r.score) for r in got}
    assert labels[304] == ("gpl-3", 1.0) and labels[305] == ("", 0.0) and labels[306] == ("mit", 1.0) and labels[307] == ("", 0.0)
    assert licenses.scan(empty(spark)).count() == 0


def test_each_template_finds_itself(spark):
    rows = [(i, "Before, " + t.text.upper() + ". After", "s") for i, t in enumerate(licenses.TEMPLATES)]
    got = {r.doc_id: r.labels for r in licenses.scan(edge(spark, rows)).collect()}
    assert all(t.label in got[i].split(",") for i, t in enumerate(licenses.TEMPLATES))


def test_no_notice_hides_another(spark):
    text = {t.label: t.text for t in licenses.TEMPLATES}
    mixes = [("bsd", "mpl-2", "cc-by-sa"), ("isc", "unlicense"), ("bsd", "isc"), tuple(text)]
    rows = [(i, ". And: ".join(text[x] for x in mix), "s") for i, mix in enumerate(mixes)]
    rows += [(100 + i, text["cc-by-sa"] + " free and unencumbered", "hot") for i in range(40)]
    got = {r.doc_id: r.labels.split(",") for r in licenses.scan(edge(spark, rows)).collect()}
    assert all(set(mix) <= set(got[i]) for i, mix in enumerate(mixes))


def test_labels_and_scores_against_brute_force(spark):
    """Every start of every template in every text, by the definition."""
    import math
    import random

    rng = random.Random(4)
    rows = []
    for i in range(160):
        parts = []
        for _ in range(rng.choice([0, 1, 1, 2, 5])):
            w = rng.choice(licenses.TEMPLATES).words
            a, b = (0, len(w)) if rng.random() < 0.4 else sorted(rng.sample(range(len(w) + 1), 2))
            parts += [x if rng.random() > 0.1 else rng.choice(["the", "gnu", "zzz", "free"]) for x in w[a:b]]
            parts += rng.choices(["license", "the", "a", "any", "other"], k=rng.choice([0, 0, 3]))
        rows.append((i, rng.choice([" ", "\n", ", "]).join(parts), "s"))
    rows.append((900, None, "s"))
    words = {d: SPLIT.findall((t or "").lower()) for d, t, _ in rows}
    vocabulary = sorted({w for t in licenses.TEMPLATES for w in t.words})
    idf = {w: math.log((len(rows) + 1) / (sum(w in x for x in words.values()) + 1)) for w in vocabulary}
    rank = {w: i for i, w in enumerate(sorted(vocabulary, key=lambda w: (-idf[w], w)))}
    want = {}
    for d, text, _ in rows:
        w, found, best = words[d], set(filter(None, base(text)[4].split(","))), 0.0
        for t in licenses.TEMPLATES:
            rare = sorted(enumerate(t.words), key=lambda x: (rank[x[1]], x[0]))[: licenses.RARE_WORDS]
            at = lambda o, i: w[o + i] if 0 <= o + i < len(w) else None  # noqa: B023, E731
            for o in range(-len(t.words), len(w)):
                share = sum(at(o, i) == x for i, x in rare) / len(rare)
                if share >= licenses.SHARE and all(at(o, i) == x for i, x in t.key_words()):
                    found.add(t.label)
                    best = max(best, share)
        want[d] = (",".join(sorted(found)), 1.0 if base(text)[1] else best)
    assert {r.doc_id: (r.labels, r.score) for r in licenses.scan(edge(spark, rows)).collect()} == want and len({x for x, _ in want.values()}) > 12
