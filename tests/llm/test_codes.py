"""Vector codes against plain Python integers, and against SQL."""

import hashlib
import math
from collections import defaultdict

import duckdb
import pytest

from tabloom.llm import codes

SCHEMA = "vec_id long, embedding array<double>, label string, q int, id string"


def brute(rows, parts=8, entries=16, rounds=6, scale=4096):
    kept = [(i, v, label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = max(1, -(-max((len(v) for _, v, _ in kept), default=0) // parts))
    most = codes.largest(width)
    cut = lambda v: [[max(-most, min(most, math.floor(x * scale))) for x in (v + [0.0] * (width * parts))[p * width : (p + 1) * width]] for p in range(parts)]
    vectors = [(i, cut(list(v)), label) for i, v, label in kept]
    first = {}
    for i, q, _ in sorted((x for x in vectors if x[0] is not None), key=lambda x: (x[0], x[1])):
        first.setdefault(i, q)
    books = [[first[i][p] for i in sorted(first)[:entries]] for p in range(parts)]
    if not first:
        return []
    near = lambda x, book: min((sum((a - b) ** 2 for a, b in zip(x, c)), k) for k, c in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            of = defaultdict(list)
            for _, q, _ in vectors:
                of[near(q[p], books[p])[1]].append(q[p])
            books[p] = [[sum(c) // len(of[k]) for c in zip(*of[k])] if of[k] else e for k, e in enumerate(books[p])]
    out, by_label = [], defaultdict(int)
    for i, q, label in vectors:
        found = [near(q[p], books[p]) for p in range(parts)]
        error = sum(d for d, _ in found)
        by_label[label] += error
        out.append((-1 if i is None else i, "".join(f"{k:02x}" for _, k in found), error, label))
    text = ",".join(str(x) for book in books for e in book for x in e)
    sha = hashlib.sha256(text.encode()).hexdigest()
    return sorted((i, code, error, by_label[label], sha) for i, code, error, label in out)


def got(spark, monkeypatch, rows, schema=SCHEMA):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], schema)
    monkeypatch.setattr(codes, "table", lambda *a: df)
    return sorted(((r.vec_id if r.vec_id is not None else -1), r.code, r.error, r.label_error, r.codebooks_sha256) for r in codes.op11_codes(spark, "").collect())


def sample(n, width=16):
    import random

    rnd = random.Random(n)
    return [(i, [rnd.gauss(0, 0.3) for _ in range(width)], rnd.choice(["a", "b", None])) for i in range(n)]


@pytest.mark.parametrize("rows", [
    sample(90), sample(5), [],
    # equal vectors, ties, repeated and null ids, rows to leave out, differing lengths, huge components
    [*sample(40), *[(7, [0.5] * 16, "a")] * 30, (None, [0.1] * 16, None), (-3, [-0.0002] * 16, "b"), (50, None, "a"), (51, [None] + [0.0] * 15, "a"), (52, [float("nan")] * 16, "a"), (53, [float("inf")] * 16, "a"), (54, [], "c"), (55, [1e300, -1e300, 3.0], "c"), (56, [0.25] * 19, "c")],
    [(None, [0.1] * 8, "a")],
], ids=["random", "few", "empty", "edge", "no ids"])
def test_codes_are_the_brute_force_ones(spark, monkeypatch, rows):
    assert got(spark, monkeypatch, rows) == brute(rows)


def test_sql_gives_the_same_on_a_whole_table(spark):
    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{sf}/embeddings.parquet'")
    own = codes.op11_codes(spark, sf)
    expected = con.execute(codes.op11_sql())
    names = [d[0] for d in expected.description]
    assert sorted(map(tuple, own.select(names).collect())) == sorted(expected.fetchall())


def test_decoded_vectors_are_near(spark):
    rows = sample(60)
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)
    found, books = codes.compress(df)
    for r in codes.decode(found, books).collect():
        far = sum((math.floor(4096 * a) - 4096 * b) ** 2 for a, b in zip(rows[r.id][1], r.vector))
        assert round(far) == r.error
