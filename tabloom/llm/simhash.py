"""Near-duplicate detection by SimHash with exact tiled comparison.

Fingerprints are made in Arrow batches, one per document. The distinct ones are put
into tiles of equal population count; tiles whose counts differ by more than the
radius hold no link and never meet. A pair of tiles that do meet is compared exactly
with numpy, and inside it blocks whose counts of each quarter word differ too far are
skipped as well. A pair of tiles returns a spanning forest of its links, never all of
them; components are then found on Spark.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.operators.graph import components

from .common import bounded_batches, materialise, table

SHINGLE = 4
RADIUS = 4
SEED = 42
#: Fingerprints in a tile, about: the unit that is sent to a task.
TILE = 8192
BLOCK = 1024


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The 64-bit SimHash of a text; zero if it has no word."""
    import xxhash

    w = text.encode("utf-8", "surrogatepass").lower().split() if text else []  # of bytes: A-Z and ASCII space only
    if not w:
        return 0
    data = b" ".join(w)
    size = np.fromiter(map(len, w), np.int64, len(w))
    stop = np.cumsum(size + 1) - 1
    k = min(shingle, len(w))
    starts, ends = (stop - size)[: len(w) - k + 1].tolist(), stop[k - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(data[a:b], SEED) for a, b in zip(starts, ends)], np.uint64)
    total = np.zeros(64, np.int64)
    for at in range(0, len(h), 65536):
        total += np.unpackbits(h[at : at + 65536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * total > len(h), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and fp (the fingerprint as a signed long) of every whole text."""
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint(t.as_py(), shingle) for t in b.column(1)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp)], ["doc_id", "fp"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, fp long")


def _forest(n: int, label: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Merge the classes of i and j in label (each entry the least index of its class)."""
    while True:
        a, b = label[i], label[j]
        differ = a != b
        if not differ.any():
            return
        i, j, a, b = i[differ], j[differ], a[differ], b[differ]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = label[label]
            if np.array_equal(up, label):
                break
            label[:] = up


def _quarters(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x.view(np.uint16).reshape(-1, 4)).astype(np.int16)


def compare(x: np.ndarray, y: np.ndarray | None, radius: int = RADIUS, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links within x (y None), or of those between x and y.

    Blocks are runs of fingerprints sorted by the bit counts of their four 16-bit words;
    two blocks are compared only if the ranges of those counts come within the radius.
    """

    def blocks(v: np.ndarray):
        q = _quarters(v)
        order = np.lexsort(q.T[::-1])
        v, q = v[order], q[order]
        at = np.arange(0, len(v), block)
        low, high = np.minimum.reduceat(q, at, axis=0), np.maximum.reduceat(q, at, axis=0)
        return v, at, low, high

    if not len(x) or (y is not None and not len(y)):
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    xs, xa, xl, xh = blocks(x)
    ys, ya, yl, yh = (xs, xa, xl, xh) if y is None else blocks(y)
    shift = 0 if y is None else len(xs)
    label = np.arange(shift + len(ys))
    apart = np.maximum(0, np.maximum(xl[:, None] - yh[None], yl[None] - xh[:, None])).sum(axis=2)
    for p, q in zip(*np.nonzero(apart <= radius)):
        if y is None and q < p:
            continue
        a, b = xs[xa[p] : xa[p] + block], ys[ya[q] : ya[q] + block]
        i, j = np.nonzero(np.bitwise_count(a[:, None] ^ b[None]) <= radius)
        i, j = i + xa[p], j + ya[q] + shift
        if y is None and p == q:
            i, j = i[i < j], j[i < j]
        if len(i):
            _forest(len(label), label, i, j)
    every = xs if y is None else np.concatenate([xs, ys])
    child = np.flatnonzero(label != np.arange(len(label)))
    return every[child], every[label[child]]


def links(fps: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """Links (u, v) between the distinct values of fps.fp, enough to connect all that
    are joined by steps of at most radius differing bits."""
    spark = fps.sparkSession
    bounded_batches(spark)
    distinct = fps.select("fp").distinct().withColumn("bits", F.bit_count("fp"))
    count = {r.bits: r["count"] for r in distinct.groupBy("bits").count().collect()}  # 65 rows at most
    first, n = [], 0
    for bits in range(65):
        first.append(n)
        n += -(-count.get(bits, 0) // tile)
    first.append(n)
    if not n:
        return spark.createDataFrame([], "u long, v long")
    at = F.array(*map(F.lit, first))
    end = F.get(at, F.least(F.col("bits") + radius + 1, F.lit(65)))
    parts = F.get(at, F.col("bits") + 1) - F.get(at, F.col("bits"))
    tiles = distinct.withColumn("tile", F.get(at, F.col("bits")) + F.pmod(F.xxhash64("fp"), parts).cast("int"))
    tiles = materialise(tiles.groupBy("tile", "bits").agg(F.collect_list("fp").alias("fps")), "tiles")
    # a tile meets itself and each later one whose count is within the radius
    left = tiles.select(F.col("tile").alias("a"), F.col("fps").alias("x"), F.explode(F.sequence(F.col("tile"), end - 1)).alias("tile"))
    pairs = left.join(tiles.select("tile", F.col("fps").alias("y")), "tile")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(b.num_rows):
                x = b.column(1)[k].values.to_numpy().view(np.uint64)
                same = b.column(0)[k].as_py() == b.column(2)[k].as_py()
                u, v = compare(x, None if same else b.column(3)[k].values.to_numpy().view(np.uint64), radius)
                yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], ["u", "v"])

    return pairs.select("a", "x", "tile", "y").mapInArrow(run, "u long, v long")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The class of every document: doc_id, fingerprint (16 hex digits) and component_id.

    Words are runs of non-space, A-Z lower-cased; a text of fewer words than a shingle is
    one shingle; a null text or one without words has fingerprint zero, which links like
    any other. component_id is the smallest non-null doc_id that is reached (null only if
    there is none). Repeated rows stay repeated; an empty table gives no rows; other
    columns of docs are ignored.
    """
    fps = materialise(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    least = fps.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = components(links(fps, radius))
    linked = least.join(roots, least.fp == roots.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    linked = materialise(linked, "classes")
    of_root = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = linked.join(of_root, "root").select("fp", "component_id")
    # the rows of one fingerprint may be a third of all: adaptive execution splits this join
    rows = fps.join(classes, "fp")
    return rows.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
