"""The prefix trie against a brute-force one."""

import hashlib
import zlib
from collections import defaultdict

import pytest

from tabloom.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string"


def digest(role, text):
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()


def ordered(rows):
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            convs[conv].append((turn is not None, turn or 0, digest(role or "", text or ""), role or "", text or ""))
    return {c: [t[3:] for t in sorted(ts)] for c, ts in convs.items()}


def rebuilt(rows):
    convs = ordered(rows)
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = convs.get(c - c % 5, [])[:h] + own[h:]
    return out


def brute(convs):
    members, ends, children = defaultdict(list), defaultdict(list), defaultdict(set)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
            if d:
                children[tuple(turns[: d - 1])].add(tuple(turns[:d]))
        ends[tuple(turns)].append(c)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = sum(leaves[k] for k in children[node]) or 1
        own = (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0
        saved[node] = own + sum(saved[k] for k in children[node])
    return sorted(
        (min(m), len(n), min(members[n[:-1]]) if n else None, len(m), len(children[n]), leaves[n], saved[n], hashlib.sha256(",".join(map(str, sorted(ends[n]))).encode()).hexdigest())
        for n, m in members.items()
    )


def rows_of(df):
    assert df.columns == trie.NODE[1:]
    return sorted(map(tuple, df.collect()), key=lambda r: (r[0], r[1]))


EDGE = [
    (1, None, "user", "a"), (1, 0, None, None), (1, 1, "user", ""), (1, 1, "user", "b"), (1, 1, "user", "b"),
    (2, 0, "user", "a"), (None, 0, "user", "lost"), (5, 3, "x", "long " * 4000), (6, 3, "x", "long " * 4000), (7, 0, "user", "é\U0001f600"), (5, 1, "user", "a"),
]


def many():
    """A turn that a third begin with, groups of equal conversations, and some long ones."""
    rows = []
    for c in range(240):
        if c % 3 == 0:
            turns = ["hello", f"mid {c % 4}", *(f"t{c % 7} {k}" for k in range(c % 11))]
        elif c % 3 == 1:
            turns = ["same", "in", "all"]
        else:
            turns = [f"own {c}", *(f"u{k}" for k in range(c % 5))]
        rows += [(c, k, "user" if k % 2 == 0 else "assistant", t) for k, t in enumerate(turns)]
    return rows + [(c, k, "user", f"deep {k}") for c in (1000, 1001) for k in range(300)] + [(1001, 300, "user", "one more")]


@pytest.mark.parametrize("local", [(1000, 8), (3, 1), (0, 0)])
@pytest.mark.parametrize("rows", [EDGE, many()[:2000:1]], ids=["edge", "many"])
def test_trie_is_the_brute_force_one(spark, rows, local):
    if local == (0, 0):  # every bucket is large: a round for each depth
        rows = [r for r in rows if r[0] is None or r[0] < 60]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], SCHEMA + ", ids int, bucket int")
    coded = trie.coded_turns(df)
    if local != (3, 1) or rows is EDGE:
        assert rows_of(trie.trie(coded, *local)) == brute(ordered(rows))
    else:
        small = [r for r in rows if r[0] < 1000]
        assert rows_of(trie.trie(trie.coded_turns(spark.createDataFrame(small, SCHEMA)), *local)) == brute(ordered(small))


def test_rebuilt_conversations(spark):
    rows = many()
    coded = trie.coded_turns(spark.createDataFrame(rows, SCHEMA))
    assert rows_of(trie.trie(trie.rebuilt(coded))) == brute(rebuilt(rows))


def test_only_turnless_and_empty(spark):
    coded = trie.coded_turns(spark.createDataFrame([], SCHEMA))
    assert rows_of(trie.trie(coded)) == []
    none = spark.createDataFrame([(3, [], []), (4, [], [])], "conv_id long, ids array<bigint>, sizes array<bigint>")
    assert rows_of(trie.trie(none)) == [(3, 0, None, 2, 0, 1, 0, hashlib.sha256(b"3,4").hexdigest())]


def test_query_on_a_whole_table(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert rows_of(trie.op12_trie(spark, sf)) == brute(rebuilt(rows))


def test_digests_of_many_stretches(spark):
    ids = [i * 50_000 for i in range(400)]
    rows = spark.createDataFrame([(1, 2, i) for i in reversed(ids)] + [(1, 3, 7)], "k1 long, k2 long, conv_id long")
    found = {(r.k1, r.k2): r.ends for r in trie.joined_digests(rows).collect()}
    assert found == {(1, 2): hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), (1, 3): hashlib.sha256(b"7").hexdigest()}
