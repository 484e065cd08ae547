"""Best-fit packing of tokenised documents by matching the large ones first.

Spark tokenises, cuts and numbers the pieces. How a bin is filled depends only on
how many pieces there are of each length, so the driver plans on that histogram (a
number for each length up to the capacity, whatever the input), and each piece then
finds its bin from its length and its rank among the pieces of that length.
"""

from __future__ import annotations

import base64
import json
import re
import struct
import zlib
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import bounded_batches, materialise, table

CAPACITY = 1024
END_ID = 2
#: Ranks are counted within parts of each length, so that no length is one group: one for so
#: many pieces, this many parts at least and at most.
ROWS_PER_PART, PARTS = 1_000_000, (64, 4096)
#: Words whose ids a worker keeps before it starts anew.
CACHE_WORDS = 150_000
NEWLINE_ID = 198


class TokenBytes:
    """Token ids of texts as little-endian unsigned 32-bit bytes.

    Splits at single spaces and newlines, where the tokeniser always splits too, and
    keeps the ids of words already seen; a text with two adjacent white-space
    characters goes to the tokeniser whole. An added token's content in a text is that
    token, wherever it stands, as in the tokenizers file; the texts around it are
    tokenised by themselves.
    """

    def __init__(self, ranks_path: str, pattern: str, added: tuple[tuple[str, int], ...] = ()):
        import tiktoken

        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encode = tiktoken.Encoding("byte_bpe", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.adjacent, self.inner = re.compile(r"\s\s|\x00"), re.compile(r".\s", re.S)
        self.known: dict[str, bytes] = {}
        self.added = {t: struct.pack("<I", i) for t, i in added}
        # the longest first, as in the tokenizers file
        self.split = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")") if added else None

    def whole(self, text: str) -> bytes:
        return np.array(self.encode(text), "<u4").tobytes()

    def learn(self, words: list[str]) -> None:
        if len(self.known) > CACHE_WORDS:
            self.known.clear()
        known, plain = self.known, []
        for w in words:
            if not w:
                known[w] = b""
            elif w.isspace() or self.inner.search(w):
                known[w] = self.whole(w)
            else:
                plain.append(w)
        if plain:  # a newline stands between words and in none of them
            ids = np.array(self.encode("\n".join(plain)), "<u4")
            ends = np.append(np.flatnonzero(ids == NEWLINE_ID), len(ids)) * 4
            data, at = ids.tobytes(), 0
            for w, end in zip(plain, ends.tolist(), strict=True):
                known[w] = data[at:end]
                at = end + 4

    def __call__(self, texts: list[str]) -> Iterator[bytes]:
        for text in texts:
            if self.split and any(t in text for t in self.added):
                yield b"".join(self.added[p] if p in self.added else self.plain(p) for p in self.split.split(text))
            else:
                yield self.plain(text)

    def plain(self, text: str) -> bytes:
        """The ids of a text without an added token."""
        if self.adjacent.search(text):
            return self.whole(text)
        parts = text.replace(" ", "\x00 ").replace("\n", "\x00\n\x00").split("\x00")
        try:
            return b"".join(map(self.known.__getitem__, parts))
        except KeyError:
            if len(self.known) > CACHE_WORDS:
                self.known.clear()
            self.learn([w for w in set(parts) if w not in self.known])
            return b"".join(map(self.known.__getitem__, parts))


@lru_cache(1)
def token_bytes(ranks_path: str, pattern: str, added: tuple[tuple[str, int], ...] = ()) -> TokenBytes:
    """One for each worker process, whatever the number of its tasks."""
    return TokenBytes(ranks_path, pattern, added)


def added_tokens(tokenizer_path: str) -> tuple[tuple[str, int], ...]:
    """The added tokens of a tokenizers file, with their ids."""
    with open(tokenizer_path, encoding="utf-8") as f:
        found = json.load(f)["added_tokens"]
    odd = [t["content"] for t in found if t.get("lstrip") or t.get("rstrip") or t.get("single_word")]
    if odd:
        raise ValueError(f"added tokens that take white space or whole words only aren't supported: {odd}")
    return tuple((t["content"], t["id"]) for t in found)


def token_pieces(docs: DataFrame, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text", ranks_path: str | None = None) -> DataFrame:
    """Tokenise every whole text, add the end id and cut only what is longer than
    capacity; then all pieces but the first are exactly of that length."""
    import public_tokenizers

    path, pattern = ranks_path or public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    added = added_tokens(public_tokenizers.path("byte_bpe_50k.json"))
    bounded_batches(docs.sparkSession)
    end = struct.pack("<I", END_ID)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = token_bytes(path, pattern, added)
        for batch in batches:
            of, piece, start, length, crc = [], [], [], [], []
            for i, ids in enumerate(encode(batch.column(1).to_pylist())):
                ids += end
                n = len(ids) // 4
                at, k = 0, 0
                while at < n:
                    size = (n % capacity or capacity) if at == 0 else capacity
                    of.append(i)
                    piece.append(k)
                    start.append(at)
                    length.append(size)
                    crc.append(zlib.crc32(ids[4 * at : 4 * (at + size)]))
                    at, k = at + size, k + 1
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(of, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return rows.mapInArrow(cut, f"doc_id {id_type}, piece int, start long, length long, ids_crc32 long")


def plan(counts: list[int], capacity: int = CAPACITY) -> list[tuple[int, list[tuple[int, int]]]]:
    """Fill bins: (number of bins alike, their content as (length, copies) in order).

    counts[n] is the number of pieces of length n. A bin holds at most two pieces over
    a third of the capacity; they are matched greedily, the longest with the longest
    that still fits. Shorter pieces then go, longest first, where the least room is left.
    """
    counts = list(counts)
    gaps: dict[int, list[tuple[int, list[tuple[int, int]]]]] = {}
    third = capacity // 3
    if counts[capacity]:
        gaps[0] = [(counts[capacity], [(capacity, 1)])]
    for a in range(capacity - 1, third, -1):
        b = min(a, capacity - a)
        while counts[a]:
            while b > third and not (counts[b] > (a == b)):
                b -= 1
            if b <= third:
                gaps.setdefault(capacity - a, []).append((counts[a], [(a, 1)]))
                counts[a] = 0
            elif a == b:
                n = counts[a] // 2
                gaps.setdefault(capacity - 2 * a, []).append((n, [(a, 2)]))
                counts[a] -= 2 * n
            else:
                n = min(counts[a], counts[b])
                gaps.setdefault(capacity - a - b, []).append((n, [(a, 1), (b, 1)]))
                counts[a] -= n
                counts[b] -= n
    rooms = sorted(g for g in gaps if g)
    for s in range(third, 0, -1):
        n = counts[s]
        while n:
            k = bisect_left(rooms, s)
            if k == len(rooms):  # no room left: new bins, as full as this length makes them
                per = capacity // s
                new = [(n // per, per)] * (n >= per) + [(1, n % per)] * bool(n % per)
                opened = [(m, [(s, c)], capacity - c * s) for m, c in new]
                n = 0
            else:
                g = rooms[k]
                m, content = gaps[g].pop()
                used = min(m, n)
                if used < m:
                    gaps[g].append((m - used, content))
                if not gaps[g]:
                    del gaps[g]
                    rooms.pop(k)
                content = [*content[:-1], (s, content[-1][1] + 1)] if content[-1][0] == s else [*content, (s, 1)]
                opened = [(used, content, g - s)]
                n -= used
            for m, content, g in opened:
                if g and g not in gaps:
                    rooms.insert(bisect_left(rooms, g), g)
                gaps.setdefault(g, []).append((m, content))
    return [x for g in sorted(gaps) for x in gaps[g]]


def intervals(bins: list[tuple[int, list[tuple[int, int]]]]) -> np.ndarray:
    """Rows (length, first rank, bin of it, copies in a bin, offset of the first), sorted."""
    rows, rank, base = [], {}, 0
    for m, content in bins:
        offset = 0
        for length, copies in content:
            first = rank.get(length, 0)
            rows.append((length, first, base, copies, offset))
            rank[length] = first + m * copies
            offset += length * copies
        base += m
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def pack(docs: DataFrame, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pack all rows of docs into as few sequences of at most `capacity` tokens as the method finds.

    Returns, for each piece: doc_id, piece, start, length, ids_crc32, sequence_id and
    offset. A null text counts as empty and gives one piece of the end id alone; null
    ids and repeated rows are packed like others (equal rows get places of their own);
    an empty table gives no rows; other columns are ignored.
    """
    pieces = materialise(token_pieces(docs, capacity, id_col, text_col), "pieces")
    parts = max(PARTS[0], min(PARTS[1], pieces.count() // ROWS_PER_PART))
    pieces = pieces.withColumn("part", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(parts)).cast("int"))
    count = np.zeros((capacity + 1, parts), np.int64)  # the bound of what comes to the driver
    for r in pieces.groupBy("length", "part").count().toLocalIterator():
        count[r[0], r[1]] = r[2]
    full = int(count[capacity].sum())
    count[capacity] = 0  # a piece as long as a sequence is one, and needs no place among others
    before = np.cumsum(count, axis=1) - count
    where = intervals(plan(count.sum(axis=1).tolist(), capacity))
    key = where[:, 0] << 40 | where[:, 1] if len(where) else np.zeros(0, np.int64)
    bins = int((where[:, 2] + 1).max()) if len(where) else 0
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    schema = ", ".join(f"{n} {pieces.schema[n].dataType.simpleString()}" for n in names) + ", sequence_id long, offset long"
    ranked = pieces.filter(F.col("length") < capacity).withColumn("rank", F.row_number().over(Window.partitionBy("length", "part").orderBy("doc_id", "piece", "start", "ids_crc32")).cast("long"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            col = {n: batch.column(n).to_numpy(zero_copy_only=False) for n in ("length", "part", "rank")}
            rank = before[col["length"], col["part"]] + col["rank"] - 1
            k = np.searchsorted(key, col["length"] << 40 | rank, side="right") - 1
            at, copies = rank - where[k, 1], where[k, 3]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in names), pa.array(where[k, 2] + at // copies), pa.array(where[k, 4] + at % copies * col["length"])],
                [*names, "sequence_id", "offset"],
            )

    packed = ranked.mapInArrow(place, schema)
    if not full:
        return packed
    # the pieces are a written table, so a task that is run again gives the same numbers
    alone = pieces.filter(F.col("length") == capacity).select(*names, (F.monotonically_increasing_id() + bins).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return packed.unionByName(alone)


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
