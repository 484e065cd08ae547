"""Exact set-similarity join of whole texts by their word shingles, as classes.

Two sets are linked if their Jaccard similarity is at least a threshold; classes are what
links connect. Columns and joins, with shingles made from word hashes in Arrow batches:

- Texts of one set of shingles are one member from the start, so copies never meet.
- Under any fixed order of shingles, two sets that are linked share a shingle within
  their prefixes, which are a fifth of each set at 0.8. Here frequent shingles come last
  in that order (a bitmap of fixed size, made from a part of the sets, says which ones
  seem frequent; the order decides only how many sets meet, never what is found).
- Sets that share a prefix shingle are first compared with one of them only, whose links
  join the bulk of each group of near copies. Then all that are still in different
  classes are compared, where their sizes, the place of their first shared shingle and the
  number that their prefixes share allow a link. So a group never becomes all its pairs,
  and no link between classes is missed.
- Only prefixes and texts are kept; the sets of those to compare are made again.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.functions.text import tokens
from tabloom.session import bounded_batches, delete, materialise

from .graph import components

SHINGLE, SIMILARITY = 5, 0.8
#: Rounds in which each set is compared with one other, before all are.
ROUNDS = 2
#: One set in so many is looked at for frequent shingles; those found so often in them come last. Words of 64 bits of their bitmap: 1 MB.
LOOKED_AT, FREQUENT, BITMAP = 16, 4, 1 << 17
#: Shingles are 62 bits of a hash; this bit is set for those that come last.
LAST = 1 << 62


#: Words of a shingle are multiplied by powers of this, by place.
FIRST = 0x9E3779B97F4A7C15


def _sets(words: pd.Series, k: int) -> list[np.ndarray]:
    """The distinct k-word shingles of rows of word hashes, sorted, as hashes of 62 bits."""
    factors = np.array([pow(FIRST, j + 1, 1 << 64) for j in range(k)], np.uint64)
    out = []
    for w in words:
        w = np.asarray(w, np.int64).view(np.uint64)
        m = min(len(w), k)
        if not m:
            out.append(np.zeros(0, np.int64))
            continue
        x = np.full(len(w) - m + 1, m, np.uint64)  # a text of fewer words is one shingle
        for j in range(m):
            x += w[j : len(w) - m + 1 + j] * factors[j]
        x ^= x >> np.uint64(32)
        x *= np.uint64(0xD6E8FEB86659FD93)
        x ^= x >> np.uint64(32)
        out.append(np.unique((x >> np.uint64(2)).view(np.int64)))
    return out


def _word_hashes(text: Column | str) -> Column:
    return F.transform(tokens(text), lambda w: F.xxhash64(w))


def shingle_hashes(text: Column | str, k: int = SHINGLE) -> Column:
    """The distinct k-word shingles of a text as hashes of 62 bits, sorted. A text of fewer words is
    one shingle, one without words has none; null is a text without words. Words are made and
    hashed by expressions; Arrow batches of their hashes become shingles."""
    @F.pandas_udf("array<bigint>")
    def made(words: pd.Series) -> pd.Series:
        return pd.Series(_sets(words, k), dtype=object)

    return made(_word_hashes(text))


def _prefixes(text: Column | str, bitmap: Broadcast, similarity: float, k: int) -> Column:
    """Of a text's set: its size n, the prefix in the order in which frequent shingles come
    last, and 128 bits of the set as its key."""
    @F.pandas_udf("n int, prefix array<bigint>, key binary")
    def made(words: pd.Series) -> pd.DataFrame:
        bits, prefixes, sets = bitmap.value, [], _sets(words, k)
        for s in sets:
            last = (bits[(s >> 6) % len(bits)] >> (s & 63)) & 1
            placed = np.concatenate([s[last == 0], s[last == 1] + LAST])
            prefixes.append(placed[: len(s) - math.ceil(len(s) * similarity - 1e-9) + 1])
        digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
        return pd.DataFrame({"n": np.array([len(s) for s in sets], np.int32), "prefix": pd.Series(prefixes, dtype=object), "key": digests})

    return made(_word_hashes(text))


def _bitmap(hashes: DataFrame, words: int) -> DataFrame:
    """One row with the bitmap of shingles h that seem frequent."""
    seen = hashes.groupBy("h").count().filter(F.col("count") >= FREQUENT)
    bits = seen.select(F.pmod(F.shiftright("h", 6), F.lit(words)).alias("word"), F.expr("shiftleft(1L, CAST(h & 63 AS INT))").alias("bits"))
    blank = hashes.sparkSession.range(words).select(F.col("id").alias("word"), F.lit(0).cast("long").alias("bits"))
    each = bits.union(blank).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    return each.agg(F.sort_array(F.collect_list(F.struct("word", "bits"))).getField("bits").alias("bitmap"))  # as long as words


def _verified(pairs: DataFrame, texts: DataFrame, similarity: float, k: int) -> DataFrame:
    """Those of pairs (a, b) whose sets are alike enough. The sets of these rows are made
    from their texts again, which takes less room than keeping all sets."""
    pairs = materialise(pairs, "pairs")
    rows = pairs.select(F.explode(F.array("a", "b")).alias("row")).distinct()
    sets = materialise(texts.join(rows, "row", "left_semi").select("row", "n", shingle_hashes("text", k).alias("s")), "met_sets")
    a, b = (sets.select(F.col("row").alias(x), F.col("s").alias(f"s{x}"), F.col("n").alias(f"n{x}")) for x in "ab")
    both = F.size(F.array_intersect("sa", "sb"))
    found = pairs.join(b, "b").join(a, "a").filter(both >= F.lit(similarity) * (F.col("na") + F.col("nb") - both) - 1e-9).select("a", "b")
    found = materialise(found, "found")
    _drop(sets)
    return found


def _drop(table: DataFrame) -> None:
    """Delete a materialised table that nothing reads any more."""
    for path in table.inputFiles()[:1]:
        delete(table.sparkSession, path.rsplit("/", 1)[0])


def _meeting(posts: DataFrame, apart: Column) -> DataFrame:
    """Places whose shingle has sets that are apart, as an aggregate tells. It is made by
    shingle first, so only these few places are dealt further."""
    meet = posts.groupBy("k").agg(apart.alias("apart")).filter("apart").select("k")
    return posts.join(meet, "k", "left_semi")


def _relabelled(posts: DataFrame, links: DataFrame) -> DataFrame:
    """Places (k, row, n, pos) with the class of each set so far, where classes meet."""
    roots = components(links.select(F.col("a").alias("u"), F.col("b").alias("v")))
    out = posts.drop("class").join(roots, F.col("row") == F.col("node"), "left").select("k", "row", "n", "pos", F.coalesce("root", "row").alias("class"))
    return materialise(_meeting(materialise(out, "places"), F.min("class") < F.max("class")), "meeting")


def _fits(x: str, y: str, similarity: float) -> Column:
    """Whether sizes leave room for enough others."""
    nx, ny = F.col(f"{x}.n"), F.col(f"{y}.n")
    return (nx >= similarity * ny - 1e-9) & (ny >= similarity * nx - 1e-9)


def _room(x: str, y: str, similarity: float) -> Column:
    """Whether the places of a shared shingle, if it is their first, leave room for enough others."""
    nx, ny = F.col(f"{x}.n"), F.col(f"{y}.n")
    room = F.least(nx - F.col(f"{x}.pos"), ny - F.col(f"{y}.pos"))
    return room * (1 + similarity) >= similarity * (nx + ny) - 1e-9


def _apart(meeting: DataFrame, similarity: float) -> DataFrame:
    """Pairs (a, b) of sets of different classes that may be alike enough. All shingles that
    two prefixes share are counted: any other that the sets share comes after the end of
    one of the prefixes, so that it is among what this set has beyond it."""
    met = meeting.alias("x").join(meeting.alias("y"), "k").filter((F.col("x.class") < F.col("y.class")) & _fits("x", "y", similarity))
    nx, ny = F.min("x.n"), F.min("y.n")
    enough = similarity * (nx + ny) - 1e-9
    beyond = F.ceil(F.greatest(nx, ny) * F.lit(similarity) - 1e-9) - 1
    room = F.least(nx - F.min("x.pos"), ny - F.min("y.pos"))  # their first shared shingle and what follows
    may = ((F.count("*") + beyond) * (1 + similarity) >= enough) & (room * (1 + similarity) >= enough)
    return met.groupBy(F.col("x.row").alias("a"), F.col("y.row").alias("b")).agg(may.alias("may")).filter("may").select("a", "b")


def linked(rows: DataFrame, similarity: float = SIMILARITY, k: int = SHINGLE, rounds: int = ROUNDS) -> DataFrame:
    """Links (a, b) between rows (row, text, n, prefix), no two of which have equal sets:
    enough to connect all that are joined by steps of at least that similarity."""
    posts = rows.select("row", "n", F.posexplode("prefix").alias("pos", "k"))
    meeting = materialise(_meeting(posts, F.count("*") > 1).withColumn("class", F.col("row")), "meeting")
    texts, links = rows.select("row", "n", "text"), None
    for turn in range(rounds):
        mixed = F.xxhash64("class", F.lit(turn))  # another one in each round
        lead = meeting.groupBy("k").agg(F.min(F.struct(mixed.alias("m"), "row", "class", "n", "pos")).alias("l")).select("k", "l.row", "l.class", "l.n", "l.pos")
        met = meeting.alias("x").join(lead.alias("y"), "k").filter((F.col("x.class") != F.col("y.class")) & _fits("x", "y", similarity) & _room("x", "y", similarity))
        shared = met.groupBy(F.col("x.row").alias("a"), F.col("y.row").alias("b")).agg(F.count("*").alias("c"))
        best = shared.groupBy("a").agg(F.max(F.struct("c", "b")).alias("best")).select("a", F.col("best.b").alias("b"))  # one for each set
        found = _verified(best, texts, similarity, k)
        links = found if links is None else links.union(found)
        meeting = _relabelled(meeting, links)
    found = _verified(_apart(meeting, similarity), texts, similarity, k)
    return found if links is None else links.union(found)


def classes(docs: DataFrame, id_col: str, text_col: str, similarity: float = SIMILARITY, k: int = SHINGLE, words: int = BITMAP, rounds: int = ROUNDS) -> DataFrame:
    """Each row's id, set_id (the smallest id with the same set of shingles), class_id (the
    smallest id that links reach) and shingles (how many its set has).

    A text of fewer than k words is one shingle. Texts without words, null ones too, are
    alike to none: both ids are the row's own. Rows with a null id are members like
    others, but an id that is smallest isn't null unless there is no other. Repeated rows
    stay; an empty table gives no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    part = docs.filter(F.pmod(F.xxhash64("text"), F.lit(LOOKED_AT)) == 0).select(F.explode(shingle_hashes("text", k)).alias("h"))
    bitmap = spark.sparkContext.broadcast(np.array(_bitmap(part, words).first()[0], np.int64))  # of a fixed size
    rows = docs.select("id", "text", _prefixes("text", bitmap, similarity, k).alias("s"), F.monotonically_increasing_id().alias("row"))
    rows = rows.select("id", "text", "s.n", "row", "s.prefix", "s.key")
    rows = materialise(rows, "prefixes")
    key = ["n", "key"]
    named = materialise(rows.filter("n > 0").groupBy(*key).agg(F.min("id").alias("set_id"), F.min("row").alias("row")), "members")
    one = rows.join(named.select("row"), "row", "left_semi").select("row", "n", "prefix", "text")
    roots = components(linked(one, similarity, k, rounds).select(F.col("a").alias("u"), F.col("b").alias("v")))
    of = materialise(named.join(roots, F.col("row") == F.col("node"), "left").select(*key, "set_id", F.coalesce("root", "row").alias("root")), "classes")
    least = of.groupBy("root").agg(F.min("set_id").alias("class_id"))
    # one text may be a third of all rows: adaptive execution splits this join
    known = rows.filter("n > 0").select("id", *key).join(of.join(least, "root").select(*key, "set_id", "class_id"), key).select("id", "set_id", "class_id", F.col("n").alias("shingles"))
    none = rows.filter("n = 0").select("id", F.col("id").alias("set_id"), F.col("id").alias("class_id"), F.lit(0).alias("shingles"))
    return known.union(none).withColumnRenamed("id", id_col)
