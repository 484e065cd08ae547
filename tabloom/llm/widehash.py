"""Near-duplicate classes by five-word shingles: SimHash of 256 bits, then exact similarity.

At a similarity of 0.8, fingerprints of 64 bits differ in 10 bits on average, as far
apart as unrelated texts come in a large corpus; with 256 bits copies at 0.8 differ in
about 39 and unrelated texts in 128. Fingerprints are of distinct shingles, as the
similarity is one of sets, and texts with one set of shingles are one node: no others are
taken as alike without being compared. A fingerprint is an estimate, so what is within
RADIUS is only a candidate, and links are verified by the Jaccard similarity of the
texts' shingle sets.

Which fingerprints are compared comes from an index of each text's first shingles, in
one order for all texts, by hash with the frequent ones last: of two texts that reach
the similarity either has so many shingles that the other has too that one of these is
among the first of both (as many as a text may lack, and one). So the work grows with
the texts and not with their pairs. Texts that meet under a shingle of few texts are
compared there. Those under one of many (large groups of copies, mostly) are compared
with each other in tiles by number of shingles, exact exclusive-or and bit counts with
numpy; tiles whose numbers are too far apart for the similarity don't meet.

Pairs within a large group are never all made. A pair of tiles returns a minimum
spanning forest by differing bits, which has the closest links there are. Where one of
these isn't verified, its component is disputed: its texts' shingle sets are compared
exactly, in tiles too, and a pair of tiles returns a forest of what links classes that
were apart. Of the pairs under a shingle of few texts a star of each text's neighbours
is verified first, and others only where they may still join classes. So two texts whose
similarity is 0.8 or more and whose fingerprints are within RADIUS always end in one class.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.operators.graph import components

from .common import bounded_batches, materialise
from .simhash import _forest

WORDS = 4
SHINGLE = 5
SIMILARITY = 0.8
#: Of 256 bits. Texts at a similarity of 0.8 differ in 39 on average, with a deviation of 5.7: one pair in a thousand of
#: those exactly at 0.8 lies beyond.
RADIUS = 56
#: Shingles of the texts in a tile of a disputed component: 16 MB.
TILE_SHINGLES = 2_000_000
#: Fingerprints in a tile. What pairs of tiles move is inverse to it: at 16,384 (0.7 MB) a quarter of what it is at 4,096.
TILE, BLOCK = 16384, 512
NAMES = [f"w{i}" for i in range(WORDS)]
MOST_PARTITIONS = 4096
#: Texts under one shingle of the index whose pairs are all made; those of more are compared in tiles.
FEW = 64
#: Shingles are frequent, and last in the order, that stand in so many of one text in ONE_IN; so many of these at most. That
#: is an estimate that only sets the order: any order gives the same classes, a good one makes groups of the index small.
FREQUENT, ONE_IN, MOST_FREQUENT = 4, 16, 200_000
#: Entries of the index in a task, and kinds of hashes that they are dealt by.
ENTRIES, DEALT = 500_000, 4096
#: Texts are tiled by the number of their shingles, in steps of this ratio.
STEP = 1.06


def _spans(text: str | None, shingle: int) -> tuple[bytes, list[tuple[int, int]]]:
    """The words of a text, joined, and where its shingles stand in it; none without a word."""
    w = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not w:
        return b"", []
    k = min(shingle, len(w))
    size = np.fromiter(map(len, w), np.int64, len(w))
    stop = np.cumsum(size + 1) - 1
    return b" ".join(w), list(zip((stop - size)[: len(w) - k + 1].tolist(), stop[k - 1 :].tolist()))


def _distinct(data: bytes, spans: list[tuple[int, int]]) -> Iterator[list[bytes]]:
    """The distinct shingles of a text, in runs of bounded length."""
    import xxhash

    step = 32768
    if len(spans) > step:  # by their hashes, so that a very long text's shingles are never all held
        h = np.fromiter((xxhash.xxh3_64_intdigest(data[a:b]) for a, b in spans), np.uint64, len(spans))
        spans = [spans[i] for i in np.unique(h, return_index=True)[1].tolist()]
        yield from ([data[a:b] for a, b in spans[at : at + step]] for at in range(0, len(spans), step))
    elif spans:
        yield list(dict.fromkeys([data[a:b] for a, b in spans]))


#: No shingle is frequent.
NONE = np.zeros((2, 0), np.uint64)


def first(hashes: np.ndarray, frequent: np.ndarray, similarity: float) -> np.ndarray:
    """The first of a text's shingles in the order of all: by hash, those of frequent (their hashes,
    sorted, and how frequent each is) last; as many as it may lack of those of a text that is so
    similar, and one."""
    n = len(hashes)
    most = n - math.ceil(similarity * n - 1e-9) + 1 if n else 0
    hashes = np.sort(hashes)
    if frequent.shape[1] and most:
        at = np.minimum(np.searchsorted(frequent[0], hashes), frequent.shape[1] - 1)
        hashes = hashes[np.argsort(np.where(frequent[0][at] == hashes, frequent[1][at], 0), kind="stable")]
    return hashes[:most]


def fingerprint(text: str | None, shingle: int = SHINGLE, frequent: np.ndarray = NONE, similarity: float = SIMILARITY) -> tuple[np.ndarray, int, bytes]:
    """Four 64-bit words by hashes of the text's distinct shingles, each with a seed of its
    own, and two that tell sets of shingles apart (sums of 64-bit hashes); the number of
    these shingles; the hashes of the first of them."""
    import xxhash

    digest = xxhash.xxh3_128_digest
    total, key, hashes = np.zeros(64 * WORDS, np.int64), np.zeros(2, np.uint64), [np.zeros(0, np.uint64)]
    for parts in _distinct(*_spans(text, shingle)):
        raw = np.frombuffer(b"".join([digest(p, 42) + digest(p, 43) for p in parts]), np.uint8).reshape(len(parts), -1)
        total += np.unpackbits(raw, axis=1, bitorder="little").sum(axis=0, dtype=np.uint16)  # of fewer than 65,536
        key += raw.view(np.uint64)[:, :2].sum(axis=0, dtype=np.uint64)
        hashes.append(raw.view(np.uint64)[:, 0])
    hashes = np.concatenate(hashes)
    return np.concatenate([np.packbits(2 * total > len(hashes), bitorder="little").view(np.uint64), key]), len(hashes), first(hashes, frequent, similarity).tobytes()


def shingle_set(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    """The distinct shingles of a text, as hashes."""
    import xxhash

    data, spans = _spans(text, shingle)
    return np.unique(np.fromiter((xxhash.xxh3_64_intdigest(data[a:b]) for a, b in spans), np.uint64, len(spans))).view(np.int64)


KEY = ["none", "id", "k1", "k2"]
#: What belongs to a set of shingles: two that tell sets apart (texts of one set are alike at 1, and of equal fingerprints
#: only those), the number of shingles, and the first ones.
SET = ["s1", "s2", "n", "first"]


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """What tells rows apart: whether an id is missing, the id, and 128 bits of the text; and the text."""
    i, t = F.col(id_col), F.col(text_col).cast("string")
    return docs.select(i.isNull().alias("none"), i.alias("id"), F.xxhash64(t).alias("k1"), F.xxhash64(F.lit("k"), t).alias("k2"), t.alias("text"))


def _by_text(rows: DataFrame, columns: list[str], make, schema: str, fields) -> DataFrame:
    """columns of rows and, in Arrow batches, what make gives for each text."""
    bounded_batches(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], *fields([make(t.as_py()) for t in b.column(b.num_columns - 1)])], names)

    names = [*columns, *(x.split()[0] for x in schema.split(", "))]
    types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.select(*columns).schema)
    return rows.select(*columns, "text").mapInArrow(run, f"{types}, {schema}")


def frequent_shingles(docs: DataFrame, shingle: int = SHINGLE, text_col: str = "text") -> np.ndarray:
    """Shingles of many texts, as sorted hashes, and of how many, by one distinct text in ONE_IN."""
    import xxhash

    bounded_batches(docs.sparkSession)
    t = F.col(text_col).cast("string")
    some = docs.select(t.alias("text")).filter(F.col("text").isNotNull() & (F.pmod(F.xxhash64("text"), F.lit(ONE_IN)) == 0)).distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_128_digest
        for b in batches:
            for at in range(0, b.num_rows, 128):  # few at once, as each shingle is a row
                texts = b.column(0)[at : at + 128].to_pylist()
                raw = b"".join([digest(p, 42) for text in texts for parts in _distinct(*_spans(text, shingle)) for p in parts])
                h, n = np.unique(np.frombuffer(raw, np.uint64)[::2], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n)], ["h", "n"])

    many = some.mapInArrow(run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).filter(F.col("n") >= FREQUENT)
    found = np.array([tuple(r) for r in many.orderBy(F.desc("n"), "h").limit(MOST_FREQUENT).collect()], np.int64).reshape(-1, 2).T.view(np.uint64)
    return np.ascontiguousarray(found[:, np.argsort(found[0])])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text", frequent: np.ndarray = NONE, similarity: float = SIMILARITY) -> DataFrame:
    """The key of every row, the words of its fingerprint as signed longs, and what belongs to its set."""
    longs = [*NAMES, *SET[:2]]

    def columns(made):
        fp = np.array([m[0] for m in made], np.uint64).reshape(-1, len(longs)).view(np.int64)
        return [*(pa.array(np.ascontiguousarray(fp[:, i])) for i in range(len(longs))), pa.array([m[1] for m in made], pa.int64()), pa.array([m[2] for m in made], pa.binary())]

    return _by_text(_keyed(docs, id_col, text_col), KEY, lambda t: fingerprint(t, shingle, frequent, similarity), ", ".join(f"{n} long" for n in [*longs, "n"]) + ", first binary", columns)


def meeting(hashes: np.ndarray, sets: np.ndarray, sizes: np.ndarray, similarity: float, few: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of entries of the index (shingle, set, number of the set's shingles): the pairs of sets (u < v)
    that meet under a shingle of few sets and whose numbers allow the similarity, each once; and
    the sets under one of more."""
    order = np.lexsort((sets, hashes))
    hashes, sets, sizes = hashes[order], sets[order], sizes[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (sets[1:] != sets[:-1])  # a set stands there once for each of its rows
    hashes, sets, sizes = hashes[new], sets[new], sizes[new]
    at = np.flatnonzero(np.concatenate([np.ones(min(1, len(hashes)), bool), hashes[1:] != hashes[:-1]]))
    held = np.diff(np.append(at, len(hashes)))
    held_by = np.repeat(held, held)
    many = np.unique(sets[held_by > few])
    some = (held_by > 1) & (held_by <= few)
    hashes, sets, sizes = hashes[some], sets[some], sizes[some]
    us, vs = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for step in range(1, min(few, len(hashes))):
        m, n = sizes[:-step], sizes[step:]
        i = np.flatnonzero((hashes[:-step] == hashes[step:]) & (np.minimum(m, n) >= similarity * np.maximum(m, n) - 1e-9))
        us.append(sets[i])
        vs.append(sets[i + step])
    u, v = np.concatenate(us), np.concatenate(vs)
    order = np.lexsort((v, u))
    u, v = u[order], v[order]
    new = np.ones(len(u), bool)
    new[1:] = (u[1:] != u[:-1]) | (v[1:] != v[:-1])
    return u[new], v[new], many


def indexed(sets: DataFrame, similarity: float, few: int | None = None) -> DataFrame:
    """Pairs (u, v) of sets (s1, n, first) that meet in the index under a shingle of few, and the
    sets (u, with v null) that stand under one of more."""
    few = few or FEW
    total = sets.agg(F.sum(F.length("first") / 8)).first()[0] or 0
    parts = max(1, min(MOST_PARTITIONS, math.ceil(total / ENTRIES)))
    dealt = min(DEALT, 8 * parts)

    def blobs(x: np.ndarray, at: np.ndarray) -> pa.Array:
        data = x.tobytes()
        return pa.array([data[a * x.itemsize : b * x.itemsize] for a, b in zip(at[:-1].tolist(), at[1:].tolist())], pa.binary())

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own = b.column(2).to_pylist()
            times = np.fromiter((len(x) // 8 for x in own), np.int64, len(own))
            h = np.frombuffer(b"".join(own), np.uint64)
            to = (h % np.uint64(dealt)).astype(np.int64)
            order = np.argsort(to, kind="stable")
            at = np.searchsorted(to[order], np.arange(dealt + 1))
            s, n = (np.repeat(b.column(i).to_numpy(), times)[order] for i in (0, 1))
            # half of a hash goes with what it is dealt by: shingles that agree in both make pairs too many, and none too few
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(dealt)), blobs((h[order] >> np.uint64(32)).astype(np.uint32), at), blobs(s, at), blobs(n.astype(np.int32), at)], ["to", "h", "s", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [[], [], [], []]
        for b in batches:
            times = np.fromiter((len(x) // 4 for x in b.column(1).to_pylist()), np.int64, b.num_rows)
            held[0].append(np.repeat(b.column(0).to_numpy(), times).tobytes())
            for x, i in zip(held[1:], (1, 2, 3)):
                x += b.column(i).to_pylist()
        to, h, s, n = (np.frombuffer(b"".join(x), t) for x, t in zip(held, (np.uint64, np.uint32, np.int64, np.int32)))
        u, v, many = meeting(to << np.uint64(32) | h, s, n, similarity, few)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([u, many])), pa.concat_arrays([pa.array(v), pa.nulls(len(many), pa.int64())])], ["u", "v"])

    # a task holds the entries of its shingles, as many as those of any other
    entries = sets.select("s1", "n", "first").mapInArrow(deal, "to long, h binary, s binary, n binary").filter(F.length("h") > 0)
    return entries.repartition(parts, "to").mapInArrow(run, "u long, v long")


def tiling(count: dict[int, int], radius: int, tile: int) -> tuple[list[int], list[int], list[int], list[int], int]:
    """For each step of numbers of shingles: its first tile, how many it is dealt to, and the range of
    tiles that its tile meets (first and last); and the number of tiles. Rare steps share one."""
    top = 64 * WORDS + 1
    first, parts, n, fill = [0] * top, [1] * top, 0, 0
    for b in range(top):
        c = count.get(b, 0)
        if c > tile or fill + c > tile:
            n, fill = n + (fill > 0), 0
        first[b], parts[b] = n, max(1, -(-c // tile))
        if c > tile:
            n += parts[b]
        else:
            fill += c
    n += fill > 0
    have = [b for b in range(top) if count.get(b)]
    low, high = [0] * top, [0] * top
    for b in have:
        mates = [x for x in have if first[x] == first[b]]
        near = [x for x in have if mates[0] - radius <= x <= mates[-1] + radius]
        low[b], high[b] = first[near[0]], first[near[-1]] + parts[near[-1]] - 1
    return first, parts, low, high, n


def spanning(n: int, i: np.ndarray, j: np.ndarray, d: np.ndarray) -> np.ndarray:
    """Which of the pairs (i, j) at distances d are a minimum spanning forest: in each round
    every class takes its shortest link (ties by place)."""
    order = np.argsort(d, kind="stable")
    i, j = i[order], j[order]
    label, rank, taken = np.arange(n), np.arange(len(order)), [np.zeros(0, np.int64)]
    while True:
        a, b = label[i[rank]], label[j[rank]]
        rank, a, b = rank[a != b], a[a != b], b[a != b]
        if not len(rank):
            return order[np.concatenate(taken)]
        least = np.full((2, n), len(order))
        for side, of in zip(least, (a, b)):
            side[of[::-1]] = rank[::-1]  # ranks ascend, so the least is put last
        pick = np.unique(least.min(axis=0))
        pick = pick[pick < len(order)]
        taken.append(pick)
        _forest(n, label, i[pick], j[pick])


def _apart(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Differing bits of each pair of fingerprints, given as rows of words."""
    far = np.zeros((x.shape[1], y.shape[1]), np.uint16)
    for k in range(WORDS):
        far += np.bitwise_count(x[k, :, None] ^ y[k, None])
    return far


def compare(x: tuple[np.ndarray, np.ndarray], y: tuple[np.ndarray, np.ndarray] | None, radius: int = RADIUS, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray]:
    """A minimum spanning forest, as pairs of ids, of the links within x (ids and fingerprints), or between x and y."""

    def blocks(v):
        bits = np.bitwise_count(v[1]).astype(np.int16)
        order = np.argsort(bits.sum(axis=1), kind="stable")
        at, bits = np.arange(0, len(order), block), bits[order]
        return v[0][order], np.ascontiguousarray(v[1][order].T), at, np.minimum.reduceat(bits, at, axis=0), np.maximum.reduceat(bits, at, axis=0)

    xi, xs, xa, xl, xh = blocks(x)
    yi, ys, ya, yl, yh = (xi, xs, xa, xl, xh) if y is None else blocks(y)
    shift = 0 if y is None else len(xi)
    every = xi if y is None else np.concatenate([xi, yi])
    held, waiting = [np.zeros((3, 0), np.int64)], 0
    apart = np.maximum(0, np.maximum(xl[:, None] - yh[None], yl[None] - xh[:, None])).sum(axis=2)
    for p, q in zip(*np.nonzero(apart <= radius)):
        if y is None and q < p:
            continue
        far = _apart(xs[:, xa[p] : xa[p] + block], ys[:, ya[q] : ya[q] + block])
        i, j = np.nonzero(far <= radius)
        if not len(i):
            continue
        d, i, j = far[i, j].astype(np.int64), i + xa[p], j + ya[q] + shift
        if y is None and p == q:
            d, i, j = d[i < j], i[i < j], j[i < j]
        held.append(np.stack([i, j, d]))
        waiting += len(i)
        if waiting > 4 * len(every) + block * block:  # a forest of forests is one of all pairs
            e = np.concatenate(held, axis=1)
            held, waiting = [e[:, spanning(len(every), *e)]], 0
    e = np.concatenate(held, axis=1)
    e = e[:, spanning(len(every), *e)]
    return every[e[0]], every[e[1]]


def alike(x: tuple, y: tuple | None, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of ids, within x or between x and y, of texts whose sets are alike: a forest that
    joins the classes which such pairs join. x and y are ids, classes, and the sets, one
    after the other, with where each begins."""
    xi, xc, xs, xat = x
    yi, yc, ys, yat = x if y is None else y
    names, label = np.unique(np.concatenate([xc, yc]), return_inverse=True)
    at = np.arange(len(names))  # the class that each class has become
    if len(names) < 2:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    lx, ly = label[: len(xi)], label[len(xi) :]
    owner = np.repeat(np.arange(len(yi)), np.diff(yat))
    order = np.argsort(ys, kind="stable")
    found, owner = ys[order], owner[order]  # an index of shingles to texts of y
    size = np.diff(yat)
    us, vs = [], []
    for r in range(len(xi)):
        own = xs[xat[r] : xat[r + 1]]
        low, high = np.searchsorted(found, own, "left"), np.searchsorted(found, own, "right")
        n = high - low
        places = np.repeat(low - np.cumsum(n) + n, n) + np.arange(n.sum())
        shared = np.bincount(owner[places], minlength=len(yi))
        near = np.flatnonzero((shared > 0) & (shared >= similarity * (len(own) + size - shared) - 1e-9))
        for c in np.unique(at[ly[near]], return_index=True)[1]:
            a, b = at[lx[r]], at[ly[near[c]]]
            if a != b:
                at[at == max(a, b)] = min(a, b)
                us.append(xi[r])
                vs.append(yi[near[c]])
    return np.array(us, np.int64), np.array(vs, np.int64)


def _step(n: Column) -> Column:
    """The step of a number of shingles; the last one has all beyond three million."""
    return F.least(F.floor(F.log(F.greatest(n, F.lit(1)).cast("double")) / F.lit(math.log(STEP))), F.lit(64 * WORDS)).cast("int")


def links(fps: DataFrame, similarity: float, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """Links (u, v) between ids of distinct fingerprints (id, n and words): of each pair of tiles a
    minimum spanning forest of those of at most radius differing bits. Tiles meet whose numbers of
    shingles allow the similarity."""
    spark = fps.sparkSession
    bounded_batches(spark)
    rows = fps.withColumn("step", _step(F.col("n")))
    count = {r.step: r["count"] for r in rows.groupBy("step").count().collect()}  # 257 rows at most
    first, parts, low, high, n = tiling(count, math.floor(math.log(1 / similarity) / math.log(STEP)) + 1, tile)
    if not n:
        return spark.createDataFrame([], "u long, v long")
    of = lambda xs: F.get(F.array(*map(F.lit, xs)), F.col("step"))
    rows = rows.select("id", *NAMES, (of(first) + F.pmod(F.xxhash64("id", *NAMES), of(parts)).cast("int")).alias("tile"), of(low).alias("low"), of(high).alias("high"))
    tiles = materialise(rows.groupBy("tile").agg(F.first("low").alias("low"), F.first("high").alias("high"), F.collect_list(F.struct("id", *NAMES)).alias("rows")), "tiles")
    spread = min(MOST_PARTITIONS, n * (n + 1) // 2)
    left = tiles.select(F.col("tile").alias("a"), F.explode(F.sequence("tile", "high")).alias("b"), F.col("rows").alias("x")).repartition(spread, "a", "b")
    right = tiles.select(F.explode(F.sequence("low", "tile")).alias("a"), F.col("tile").alias("b"), F.col("rows").alias("y")).repartition(spread, "a", "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(b.num_rows):
                same = b.column(0)[k].as_py() == b.column(1)[k].as_py()
                u, v = compare(_held(b.column(2)[k]), None if same else _held(b.column(3)[k]), radius)
                yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])

    return left.join(right, ["a", "b"]).select("a", "b", "x", "y").mapInArrow(run, "u long, v long")


def _held(cell) -> tuple[np.ndarray, np.ndarray]:
    """Ids and fingerprints of a tile's rows, as arrays."""
    v = cell.values
    return v.field(0).to_numpy(), np.stack([v.field(i + 1).to_numpy().view(np.uint64) for i in range(WORDS)], axis=1)


def disputes(nodes: DataFrame, similarity: float, tile: int = TILE_SHINGLES) -> DataFrame:
    """Links (u, v) between classes within the groups of nodes (id, root of the class, s, grp)."""
    bounded_batches(nodes.sparkSession)
    size = nodes.groupBy("grp").agg(F.ceil(F.sum(F.size("s").cast("long")) / F.lit(float(tile))).alias("parts"))
    rows = nodes.join(size, "grp").withColumn("part", F.pmod(F.xxhash64("id"), F.greatest("parts", F.lit(1)))).repartition("grp", "part")  # not by group alone
    tiles = materialise(rows.groupBy("grp", "part").agg(F.first("parts").alias("parts"), F.collect_list(F.struct("id", "root", "s")).alias("rows")), "disputed")
    left = tiles.select("grp", F.col("part").alias("a"), F.explode(F.sequence("part", F.greatest(F.col("parts") - 1, "part"))).alias("b"), F.col("rows").alias("x"))
    pairs = left.join(tiles.select("grp", F.col("part").alias("b"), F.col("rows").alias("y")), ["grp", "b"]).select("a", "b", "x", "y")

    def held(cell) -> tuple[np.ndarray, ...]:
        v = cell.values
        sets = v.field(2)
        at = sets.offsets.to_numpy()
        return v.field(0).to_numpy(), v.field(1).to_numpy(), sets.values.to_numpy()[at[0] : at[-1]], at - at[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(b.num_rows):
                same = b.column(0)[k].as_py() == b.column(1)[k].as_py()
                u, v = alike(held(b.column(2)[k]), None if same else held(b.column(3)[k]), similarity)
                yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])

    return pairs.mapInArrow(run, "u long, v long")


def verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """pairs (u, v and others) with ok: whether the Jaccard similarity of their shingle sets (id, s) is that
    great. A text with many links is joined last, so its set is never copied to a table."""
    a, b = (sets.select(F.col("id").alias(x), F.col("s").alias(f"s{x}")) for x in "uv")
    both = F.size(F.array_intersect("su", "sv"))
    all_ = F.size("su") + F.size("sv")
    return pairs.join(b, "v").join(a, "u").select(*pairs.columns, (both >= F.lit(similarity) * (all_ - both) - 1e-9).alias("ok"))


def candidates(nodes: DataFrame, sets: DataFrame, similarity: float, radius: int) -> tuple[DataFrame, DataFrame]:
    """Links (u, v) between ids of nodes (id, words, s1, n): all that meet under a shingle of few
    texts and whose fingerprints are within the radius, and forests of those of the others."""
    met = materialise(indexed(sets, similarity), "met")
    ends = [nodes.select(F.col("s1").alias(x), F.col("id").alias(f"id{x}"), *(F.col(n).alias(f"{n}{x}") for n in NAMES)) for x in "uv"]
    far = sum((F.bit_count(F.col(f"{n}u").bitwiseXOR(F.col(f"{n}v"))) for n in NAMES[1:]), F.bit_count(F.col(f"{NAMES[0]}u").bitwiseXOR(F.col(f"{NAMES[0]}v"))))
    pairs = met.filter("v IS NOT NULL").distinct().join(ends[0], "u").join(ends[1], "v").filter((far <= radius) & (F.col("idu") != F.col("idv")))
    near = materialise(pairs.select(F.least("idu", "idv").alias("u"), F.greatest("idu", "idv").alias("v")).distinct(), "near")
    many = met.filter("v IS NULL").select(F.col("u").alias("s1")).distinct()
    tiled = links(materialise(nodes.join(many, "s1", "left_semi").select("id", "n", *NAMES), "many"), similarity, radius)
    return near, materialise(tiled.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(), "tiled")


def classes(docs: DataFrame, nodes: DataFrame, sets: DataFrame, shingle: int, radius: int, similarity: float, id_col: str, text_col: str) -> DataFrame:
    """The root of every node (id, words, s1, n, key) that is linked with another: (node, root)."""
    near, tiled = candidates(nodes, sets, similarity, radius)
    ends = near.select(F.explode(F.array("u", "v")).alias("id")).union(tiled.select(F.explode(F.array("u", "v")).alias("id"))).distinct()
    linked = nodes.join(ends, "id").select(F.col("id").alias("node"), *(F.col(f"key.{c}").alias(c) for c in KEY))
    same = [F.col(f"d.{c}").eqNullSafe(F.col(f"n.{c}")) if c == "id" else F.col(f"d.{c}") == F.col(f"n.{c}") for c in KEY]
    texts = _keyed(docs, id_col, text_col).alias("d").join(materialise(linked, "linked").alias("n"), same).select("node", "text")
    shingles = _by_text(texts, ["node"], lambda t: shingle_set(t, shingle), "s array<bigint>", lambda s: [pa.array(s, pa.list_(pa.int64()))])
    # rows of one id and text are one node
    shingles = materialise(shingles.groupBy("node").agg(F.first("s").alias("s")).withColumnRenamed("node", "id"), "shingles")
    # of near each node's least neighbour before it, which joins most of a class with few links
    star = near.groupBy("v").agg(F.min("u").alias("u")).select("u", "v", F.lit(False).alias("tiled"))
    found = star.union(tiled.withColumn("tiled", F.lit(True))).groupBy("u", "v").agg(F.max("tiled").alias("tiled"))
    tried = materialise(verified(found, shingles, similarity), "verified")
    good = tried.filter("ok").select("u", "v")
    roots = materialise(components(good), "roots")
    # the others of near, where they may still join classes
    root = [roots.select(F.col("node").alias(x), F.col("root").alias(f"root{x}")) for x in "uv"]
    rest = near.join(tried.select("u", "v"), ["u", "v"], "left_anti").join(root[0], "u", "left").join(root[1], "v", "left")
    rest = rest.filter(F.coalesce("rootu", "u") != F.coalesce("rootv", "v")).select("u", "v")
    late = materialise(verified(rest, shingles, similarity).filter("ok").select("u", "v"), "verified")
    disputed = tried.filter("tiled AND NOT ok")
    if disputed.isEmpty():
        return roots if late.isEmpty() else components(good.union(late))
    groups = components(tiled).select(F.col("node").alias("id"), F.col("root").alias("grp"))
    bad = disputed.join(groups, F.col("u") == F.col("id")).select("grp").distinct()
    apart = groups.join(bad, "grp").join(roots.select(F.col("node").alias("id"), "root"), "id", "left").select("id", "grp", F.coalesce("root", "id").alias("root"))
    more = disputes(apart.join(shingles, "id"), similarity)
    return components(good.union(late).union(more))


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """The rows of docs that stand for their class of near copies, one for each class.

    A class is what links connect; a link is a pair of texts whose sets of five-word
    shingles are alike at `similarity` or more (Jaccard), whose fingerprints are within the
    radius. Of a class the row with the smallest id stays, a row without an id only if none
    has one; of several texts of that id one, by a hash of the text; of equal ids and texts
    any one row. An id may be of any ordered type, repeated with other texts or null: each
    row goes by its own text. Words are runs of non-space, A-Z lower-cased; null texts and
    texts without words are alike; a text of fewer words than a shingle is one shingle. An
    empty table gives no rows; the columns are those of docs, whatever their names.
    """
    columns = docs.columns
    i, t = (f"c{columns.index(c)}" for c in (id_col, text_col))
    docs = docs.toDF(*(f"c{k}" for k in range(len(columns))))  # names that can't clash with those used here
    fps = materialise(fingerprints(docs, shingle, i, t, frequent_shingles(docs, shingle, t), similarity), "fingerprints")
    rows = fps.groupBy(*NAMES, *SET[:2]).agg(F.min(F.struct(*KEY)).alias("key"), F.max("n").alias("n"))
    nodes = materialise(rows.withColumn("id", F.monotonically_increasing_id()), "nodes")  # written once, so ids stay
    roots = classes(docs, nodes, fps, shingle, radius, similarity, i, t)
    of = nodes.join(roots.select(F.col("node").alias("id"), "root"), "id", "left").groupBy(F.coalesce("root", "id").alias("root")).agg(F.min("key").alias("key"))
    stay = materialise(of.select(*(F.col(f"key.{c}").alias(f"__{c}") for c in KEY)), "stay")
    text = F.col(t).cast("string")
    here = F.col(i).eqNullSafe(F.col("__id")) & (F.xxhash64(text) == F.col("__k1")) & (F.xxhash64(F.lit("k"), text) == F.col("__k2"))
    kept = docs.join(stay, here, "left_semi")
    # rows of equal id and text are rare: only these are dealt by their key, to keep one of each
    keyed = _keyed(docs, i, t).drop("text")
    again = materialise(keyed.groupBy(*KEY).agg(F.count("*").alias("n")).filter("n > 1").select(*(F.col(c).alias(f"__{c}") for c in KEY)), "repeated")
    if again.isEmpty():
        return kept.toDF(*columns)
    many = kept.join(again, here, "left_semi")
    one = many.withColumn("k1", F.xxhash64(text)).withColumn("k2", F.xxhash64(F.lit("k"), text)).dropDuplicates([i, "k1", "k2"]).drop("k1", "k2")
    return kept.join(again, here, "left_anti").union(one).toDF(*columns)
