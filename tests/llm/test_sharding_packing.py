import json
import random
import struct
import zlib
from collections import Counter, defaultdict

import pytest

from tabloom.llm import packing, sharding
from tabloom.llm.packing import plan

from .helpers import edge, empty


def check_shards(rows):
    places = defaultdict(list)
    for r in rows:
        places[r.shard].append(r.slot)
    assert all(sorted(p) == list(range(len(p))) for p in places.values())


def test_shards_edge_cases(spark, tmp_path):
    got = sharding.shard(edge(spark), f"file://{tmp_path}/m", 3, 64).collect()
    check_shards(got)
    assert Counter((r.doc_id, r.size) for r in got) == Counter({(1, 8): 1, (2, 8): 1, (3, 14): 1, (4, 11): 1, (5, 11): 2, (None, 21): 1, (6, 15008): 1, (7, 8 + len("\x00 nul   and \U0001f600 emoji ÄÖ".encode())): 1})
    assert {r.text_crc32 for r in got if r.doc_id == 5} == {zlib.crc32(b"one")} and {r.law for r in got} == {"bytes"}
    assert sharding.shard(empty(spark), f"file://{tmp_path}/e", 3, 64).count() == 0


def test_shards_are_nearly_equal_and_versioned(spark, tmp_path):
    random.seed(1)
    docs = spark.createDataFrame([(i, "a" * random.choice([10, 50, 2000])) for i in range(3000)], "doc_id long, text string")
    path = f"file://{tmp_path}/m"
    got = sharding.shard(docs, path, 6, 512).collect()
    check_shards(got)
    load = Counter()
    for r in got:
        load[r.shard] += r.size
    assert max(load.values()) - min(load.values()) < 0.01 * max(load.values())
    first = sharding.SlotMap.load(spark, path)
    assert first.version == 1 and sharding.SlotMap.load(spark, path, 0).shard_of == sharding.SlotMap.initial(512, 6).shard_of
    sharding.shard(docs, path, 6, 512)
    again = sharding.SlotMap.load(spark, path)
    assert again.version == 2 and len(first.moved(again)) < 60  # balanced already: few slots move


def test_rebalancing_to_more_shards():
    m = sharding.SlotMap.initial(256, 4).rebalanced([10] * 256, 5)
    assert Counter(m.shard_of).most_common()[0][1] - min(Counter(m.shard_of).values()) <= 1 and m.n_shards == 5
    one = sharding.SlotMap.initial(8, 2).rebalanced([100, 0, 0, 0, 0, 0, 0, 0])
    assert sorted(Counter(one.shard_of)) in ([0, 1], [0], [1])


@pytest.mark.parametrize("n", [1, 4, 8, 11])
def test_shards_become_fewer_or_more(n):
    rng = random.Random(n)
    load = [rng.randrange(0, 900) for _ in range(256)]
    after = sharding.SlotMap.initial(256, 8).rebalanced(load, n)
    held = [sum(b for b, s in zip(load, after.shard_of) if s == x) for x in range(n)]
    assert set(after.shard_of) == set(range(n)) and max(held) - min(held) <= max(load) and after.version == 1
    with pytest.raises(ValueError):
        after.rebalanced(load[:-1])


@pytest.mark.parametrize("seed", range(6))
def test_plans_place_every_piece(seed):
    rng = random.Random(seed)
    counts = [0] * 1025
    for _ in range(rng.choice([0, 1, 50, 5000])):
        counts[min(1024, max(1, int(rng.lognormvariate(5, 1.3))))] += 1
    bins = plan(counts)
    placed = Counter()
    for m, content in bins:
        assert m > 0 and sum(n * k for n, k in content) <= 1024 and sum(k for n, k in content if 341 < n) <= 2
        for n, k in content:
            placed[n] += m * k
    assert placed == Counter({n: c for n, c in enumerate(counts) if c})
    total = sum(n * c for n, c in enumerate(counts))
    assert sum(m for m, _ in bins) <= max(-(-total // 1024) * 1.25 + 1, sum(counts[513:]) * 1.05 + -(-total // 1024))


def test_large_items_are_matched():
    counts = [0] * 1025
    counts[600], counts[424], counts[400] = 3, 2, 1
    assert sum(m for m, _ in plan(counts)) == 3


def test_packing_round_trip(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    odd = "It's  two\n\nblank\t\ttabs \n x\r\ny it'll 12,345 «éà»   z  "
    rows = [(1, None, "s"), (2, "", "s"), (3, odd, "s"), (4, "plain words only, in lines.\nNext line's words 123 end", "s"), (4, "a" * 9000, "s"), (None, "x", "s"), (None, "x", "s"), (9, " lead", "s"), (10, "trail ", "s"), (11, "\n", "s"), (12, "zwei Wörter neu", "s")]
    rows += [(100 + i, " ".join(f"word{j}" for j in range(i * 7)), "s") for i in range(60)]
    got = packing.pack(edge(spark, rows)).collect()
    bins = defaultdict(list)
    for r in got:
        bins[r.sequence_id].append((r.offset, r.length))
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 1024
    want = Counter()
    for d, text, _ in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        cut = [0, *range(len(ids) % 1024 or 1024, len(ids), 1024), len(ids)] if len(ids) > 1024 else [0, len(ids)]
        for k, (a, b) in enumerate(zip(cut, cut[1:])):
            want[d, k, a, b - a, zlib.crc32(struct.pack(f"<{b - a}I", *ids[a:b]))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    assert packing.pack(empty(spark)).count() == 0
    least = packing.plan([0] + [sum(r.length == n for r in got) for n in range(1, 1025)])
    assert len(bins) == sum(m for m, _ in least)


def test_added_tokens_have_the_ids_of_the_tokenizers_file(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer, e = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), "<|endoftext|>"
    texts = [f"a {e} b", e, e + e, f"x\n\n  {e}\t y  z {e}", f"<{e}>", "<|endoftext|", f"word{e}word's {e}\n", "a " * 1500 + e + " b" * 1500]
    want = {}
    for i, t in enumerate(texts):
        ids = tokenizer.encode(t, add_special_tokens=False).ids + [2]
        cut = [0, *range(len(ids) % 1024 or 1024, len(ids), 1024), len(ids)] if len(ids) > 1024 else [0, len(ids)]
        want |= {(i, k): (b - a, zlib.crc32(struct.pack(f"<{b - a}I", *ids[a:b]))) for k, (a, b) in enumerate(zip(cut, cut[1:]))}
    got = packing.pack(edge(spark, [(i, t, "s") for i, t in enumerate(texts)])).collect()
    assert {(r.doc_id, r.piece): (r.length, r.ids_crc32) for r in got} == want
