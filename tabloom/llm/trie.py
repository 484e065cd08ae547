"""Conversation prefix trie by distributed MSD radix partitioning.

Turns are dictionary-encoded: equal roles and texts get one number, and texts go no
further. Equal conversations become one sequence with a weight. Sequences are dealt by
their next turn id, a round for each depth; a bucket that is small enough leaves the
rounds and is finished in one task by multikey quicksort, which emits its nodes as it
recurses. Only buckets that are still large go on, so a very common first turn costs a
round, not a task. What the nodes above the finished buckets need is added up by
grouped shuffles of one row for each bucket.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_batches, materialise, table

#: A bucket of at most so many turns, or of so few sequences, is local.
LOCAL_TURNS, LOCAL_SEQUENCES = 1000, 8
#: Conversation ids of one stretch, whose decimal text is made before it is hashed.
STRETCH = 1 << 16
EMPTY = hashlib.sha256(b"").hexdigest()


def turn_digest(role: Column, text: Column) -> Column:
    """32 bytes that tell turns apart."""
    return F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256))


def coded_turns(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Each conversation's turns in order: conv_id, ids (dictionary numbers) and sizes (UTF-8 bytes of the texts)."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    turns = conversations.filter(F.col(id_col).isNotNull()).select(F.col(id_col).alias("conv_id"), F.col(turn_col).alias("turn"), turn_digest(role, text).alias("digest"), F.octet_length(text).cast("long").alias("size"))
    dictionary = materialise(turns.select("digest").distinct().withColumn("id", F.monotonically_increasing_id()), "turns")  # written once, so numbers stay
    coded = turns.join(dictionary, "digest")  # one turn may be a third of all: adaptive execution splits it
    rows = coded.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "digest", "id", "size"))).alias("t"))
    return rows.select("conv_id", F.col("t.id").alias("ids"), F.col("t.size").alias("sizes"))


def sequences(coded: DataFrame) -> DataFrame:
    """The distinct sequences of coded (conv_id, ids, sizes): seq, ids, sizes, weight, least
    (their smallest conv_id) and ends (the digest of all of their ids), written once."""
    key = [F.xxhash64("ids").alias("k1"), F.xxhash64(F.lit("k"), "ids").alias("k2")]
    rows = materialise(coded.select("*", *key), "rebuilt")
    distinct = rows.groupBy("k1", "k2", "ids", "sizes").agg(F.count("*").alias("weight"), F.min("conv_id").alias("least"))
    out = distinct.join(joined_digests(rows), ["k1", "k2"]).select("ids", "sizes", "weight", "least", "ends")
    return materialise(out, "sequences")


def joined_digests(members: DataFrame) -> DataFrame:
    """(k1, k2, ends): SHA-256 of each key's conv_ids, ascending and joined by commas.

    Ids become text by stretches of ids, in parallel; only these few long texts meet in
    a task, which hashes them one after the other and holds none.
    """
    bounded_batches(members.sparkSession)
    stretch = F.floor(F.col("conv_id") / F.lit(STRETCH)).cast("long")
    texts = members.groupBy("k1", "k2", stretch.alias("stretch")).agg(F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("part"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, h, out = None, None, []
        for b in batches:
            for k1, k2, part in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                if (k1, k2) != now:
                    if h:
                        out.append((*now, h.hexdigest()))
                    now, h = (k1, k2), hashlib.sha256()
                else:
                    h.update(b",")
                h.update(part.as_buffer())
            if len(out) > 10_000:
                yield _digest_rows(out)
                out = []
        if h:
            out.append((*now, h.hexdigest()))
        yield _digest_rows(out)

    return texts.repartition("k1", "k2").sortWithinPartitions("k1", "k2", "stretch").select("k1", "k2", "part").mapInArrow(run, "k1 long, k2 long, ends string")


def _digest_rows(rows: list[tuple[int, int, str]]) -> pa.RecordBatch:
    k1, k2, ends = zip(*rows) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(k1, pa.int64()), pa.array(k2, pa.int64()), pa.array(ends, pa.string())], ["k1", "k2", "ends"])


#: A node as a local bucket emits it: `bucket` has a value for the bucket's top node only.
NODE = ["bucket", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
NODE_SCHEMA = "bucket long, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"


class Bucket:
    """Sequences that share their first `depth` turns; nodes() makes their subtree."""

    def __init__(self, bucket: int, depth: int, ids: list[np.ndarray], sizes: list[np.ndarray], weight: list[int], least: list[int], ends: list[str]):
        self.bucket, self.depth, self.ids, self.sizes, self.weight, self.least, self.ends = bucket, depth, ids, sizes, weight, least, ends

    def nodes(self) -> list[tuple]:
        """The nodes of the bucket, its top first; parents stand before their children."""
        out: list[list] = []
        above: list[int] = []  # the place of each node's parent in out, -1 for the top's
        ids, weight, least = self.ids, self.weight, self.least
        # rows, depth, parent; or rows among the children of a node, whose next turns aren't sorted yet
        todo: list[tuple[list[int], int, int, bool]] = [(list(range(len(ids))), self.depth, -1, True)]
        while todo:
            rows, depth, parent, whole = todo.pop()
            if not whole:  # multikey quicksort: less than, equal to and greater than a pivot's turn
                pivot = ids[rows[len(rows) // 2]][depth]
                equal, other = [], ([], [])
                for r in rows:
                    x = ids[r][depth]
                    (equal if x == pivot else other[x > pivot]).append(r)
                out[parent][5] += 1
                todo += [(o, depth, parent, False) for o in other if o]
                todo.append((equal, depth + 1, parent, True))
                continue
            if len(rows) == 1:
                self._chain(rows[0], depth, parent, out, above)
                continue
            n = sum(weight[r] for r in rows)
            size = int(self.sizes[rows[0]][depth - 1]) if depth else 0
            here = len(out)
            out.append([None, min(least[r] for r in rows), depth, None, n, 0, 0, (n - 1) * size, EMPTY])
            above.append(parent)
            longer = [r for r in rows if len(ids[r]) > depth]
            for r in rows:
                if len(ids[r]) == depth:
                    out[here][8] = self.ends[r]  # one at most, as sequences are distinct
            if longer:
                todo.append((longer, depth, here, False))
        for k in range(len(out) - 1, -1, -1):  # children come after their parent
            node, parent = out[k], above[k]
            node[6] = node[6] or 1
            if parent >= 0:
                node[3] = out[parent][1]
                out[parent][6] += node[6]
                out[parent][7] += node[7]
        out[0][0] = self.bucket
        return out

    def _chain(self, r: int, depth: int, parent: int, out: list[list], above: list[int]) -> None:
        """The nodes of a sequence that shares nothing from here on; node values are made at
        once, and sums go up with the others'."""
        n, w, least = len(self.ids[r]), self.weight[r], self.least[r]
        size = self.sizes[r]
        for d in range(depth, n + 1):
            out.append([None, least, d, None, w, int(d < n), 0, (w - 1) * int(size[d - 1]) if d else 0, self.ends[r] if d == n else EMPTY])
            above.append(parent if d == depth else len(out) - 2)


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes of buckets whose sequences follow each other: bucket, depth, ids, sizes, weight, least, ends."""
    now, held = None, ([], [], [], [], [])
    nodes: list[list] = []

    def rows() -> pa.RecordBatch:
        cols = list(zip(*nodes)) if nodes else [()] * len(NODE)
        kinds = [pa.int64()] * (len(NODE) - 1) + [pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], NODE)

    for b in batches:
        lists = []
        for k in (2, 3):
            at, flat = b.column(k).offsets.to_numpy(), b.column(k).values.to_numpy()
            lists.append([flat[x:y] for x, y in zip(at[:-1].tolist(), at[1:].tolist())])
        for bucket, depth, ids, sizes, weight, least, ends in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), *lists, *(b.column(k).to_pylist() for k in (4, 5, 6))):
            if now != (bucket, depth):
                if now:
                    nodes += Bucket(*now, *held).nodes()
                now, held = (bucket, depth), ([], [], [], [], [])
            for xs, x in zip(held, (ids.tolist(), sizes, weight, least, ends)):
                xs.append(x)
            if len(nodes) > 20_000:
                yield rows()
                nodes.clear()
    if now:
        nodes += Bucket(*now, *held).nodes()
    yield rows()


def _radix(seqs: DataFrame, local_turns: int, local_sequences: int) -> tuple[DataFrame, DataFrame]:
    """The local buckets' sequences, with bucket and depth, and all buckets (bucket, parent,
    size of the last text, whether local, ends). Bucket 0 is the root."""
    spark = seqs.sparkSession
    active = seqs.select("*", F.lit(0).cast("long").alias("bucket"))
    root = F.lit(0).cast("long").alias("bucket"), F.lit(None).cast("long").alias("parent"), F.lit(0).cast("long").alias("size"), F.lit(False).alias("local"), F.lit(0).cast("long").alias("depth")
    rows, levels, depth, first = [], [("made", seqs.limit(1).select(*root))], 0, 1
    while True:
        # those that end at a large bucket are its members only
        ended = active.filter(F.size("ids") == depth).select("bucket", F.col("ends").alias("end"), F.col("least").alias("end_least"), F.col("weight").alias("end_weight"))
        levels.append(("ended", materialise(ended, "ended")))
        going = active.filter(F.size("ids") > depth).withColumn("turn", F.get("ids", F.lit(depth)))
        counts = going.groupBy("bucket", "turn").agg(F.sum(F.size("ids").cast("long") - depth).alias("turns"), F.count("*").alias("n"), F.max(F.get("sizes", F.lit(depth))).alias("size"))
        local = (F.col("turns") <= local_turns) | (F.col("n") <= local_sequences)
        made = materialise(counts.select((F.monotonically_increasing_id() + first).alias("child"), F.col("bucket").alias("parent"), "turn", "size", local.alias("local")), "buckets")
        top, large = made.agg(F.max("child"), F.count_if(~F.col("local"))).first()
        levels.append(("made", made.select(F.col("child").alias("bucket"), "parent", "size", "local", F.lit(depth + 1).cast("long").alias("depth"))))
        if top is None:
            break
        first, depth = top + 1, depth + 1
        dealt = going.join(made.select("child", F.col("parent").alias("bucket"), "turn", "local"), ["bucket", "turn"])  # a turn that many share is split
        dealt = materialise(dealt.select("ids", "sizes", "weight", "least", "ends", F.col("child").alias("bucket"), "local"), "dealt")
        rows.append(dealt.filter("local").select("bucket", F.lit(depth).cast("long").alias("depth"), "ids", "sizes", "weight", "least", "ends"))
        if not large:
            break
        active = dealt.filter("NOT local").drop("local")
    union = lambda xs: xs[0] if len(xs) == 1 else union(xs[: len(xs) // 2]).union(union(xs[len(xs) // 2 :]))
    none = spark.createDataFrame([], "bucket long, depth long, ids array<bigint>, sizes array<bigint>, weight long, least long, ends string")
    buckets = union([x for k, x in levels if k == "made"]).join(union([x for k, x in levels if k == "ended"]), "bucket", "left")
    return union(rows) if rows else none, materialise(buckets, "all_buckets")


def trie(coded: DataFrame, local_turns: int = LOCAL_TURNS, local_sequences: int = LOCAL_SEQUENCES) -> DataFrame:
    """All nodes of the prefix trie of coded (conv_id, ids, sizes): conv_id (the smallest
    member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens and
    ends_sha256.

    A node's members are the conversations that start with its turns; those that end there
    are hashed. Conversations without turns are members of the root only. An empty table
    has no root, and gives no rows. Equal conversations are members of the same nodes.
    What a task holds is a bucket (at most local_turns turns, or local_sequences
    sequences) and a batch; one sequence's turn numbers are a row, so a conversation of
    over 100 million turns is beyond it.
    """
    spark = coded.sparkSession
    bounded_batches(spark)
    seqs = sequences(coded)
    local, buckets = _radix(seqs, local_turns, local_sequences)
    done = local.repartition("bucket").sortWithinPartitions("bucket").select("bucket", "depth", "ids", "sizes", "weight", "least", "ends").mapInArrow(_finish, NODE_SCHEMA)
    done = materialise(done, "nodes")
    inner = done.filter("bucket IS NULL").select(NODE[1:])
    tops = done.filter("bucket IS NOT NULL")
    # sums of large buckets, from the deepest up: a row for each child, as its own parent sees it
    large = materialise(buckets.filter("NOT local").select("bucket", "parent", "depth", "size", "end", "end_least", "end_weight"), "large")
    deepest = large.agg(F.max("depth")).first()[0]
    if deepest is None:
        return inner.limit(0)
    known = buckets.filter("local").select("bucket", "parent", F.col("depth").alias("at"))
    below = tops.join(known, "bucket").select("parent", "at", "conv_id", "n_convs", "n_leaves", "saved_tokens")
    finished = []
    for depth in range(deepest, -1, -1):
        children = below.filter(F.col("at") == depth + 1)
        if finished:
            children = children.unionByName(finished[-1].select("parent", F.col("depth").alias("at"), "conv_id", "n_convs", "n_leaves", "saved_tokens"))
        sums = children.groupBy(F.col("parent").alias("bucket")).agg(F.min("conv_id").alias("least"), F.sum("n_convs").alias("n"), F.count("*").alias("kids"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved"))
        here = large.filter(F.col("depth") == depth).join(sums, "bucket", "left")
        n = F.coalesce("n", F.lit(0)) + F.coalesce("end_weight", F.lit(0))
        finished.append(materialise(here.select(
            "bucket", "parent", "depth", F.least("least", "end_least").alias("conv_id"), n.alias("n_convs"), F.coalesce("kids", F.lit(0)).alias("n_children"), F.coalesce("leaves", F.lit(1)).alias("n_leaves"),
            (F.coalesce("saved", F.lit(0)) + (n - 1) * F.coalesce("size", F.lit(0))).alias("saved_tokens"), F.coalesce("end", F.lit(EMPTY)).alias("ends_sha256")), "summed"))
    above = finished[0]
    for x in finished[1:]:
        above = above.unionByName(x)
    parents = above.select(F.col("bucket").alias("up"), F.col("conv_id").alias("parent_conv_id"))
    heads = tops.drop("parent_conv_id").join(known.select("bucket", "parent"), "bucket").unionByName(above)
    return inner.unionByName(heads.join(parents, F.col("parent") == F.col("up"), "left").select(NODE[1:]))


def rebuilt(coded: DataFrame, family: int = 5, most: int = 9) -> DataFrame:
    """Conversations that begin with the first h turns of another: c's are those of
    c - c % family, h the CRC-32 of c's decimal text modulo `most`; c's own follow after its first h."""
    c = F.col("conv_id")
    own = coded.select("conv_id", (c - c % family).alias("base"), (F.crc32(c.cast("string").cast("binary")) % most).cast("int").alias("h"), "ids", "sizes")
    heads = coded.select(F.col("conv_id").alias("base"), F.slice("ids", 1, most - 1).alias("head_ids"), F.slice("sizes", 1, most - 1).alias("head_sizes"))
    none = F.array().cast("array<bigint>")
    both = lambda x: F.concat(F.slice(F.coalesce(f"head_{x}", none), F.lit(1), F.col("h")), F.slice(x, F.col("h") + 1, F.size(x))).alias(x)
    return own.join(heads, "base", "left").select("conv_id", both("ids"), both("sizes"))


def op12_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = materialise(coded_turns(table(spark, sf_dir, "conversations")), "coded")
    return trie(rebuilt(coded))
