"""BPE encoding and decoding with content-defined chunk reuse.

A rolling hash of the last 32 characters cuts every text where its content says, so a
passage that many texts share is cut alike in all of them. Chunks that stand in several
places are encoded once, by one owner, and their ids go to every text that has them. A
chunk's ends may lie within a word, so where ids of a shared chunk meet others, the words
around the join are encoded again, in a window that grows until its outer words have
exactly the ids that both sides gave them. Texts without a shared chunk never move: a
filter of fixed size, sent to every task, tells which ones have one.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections import OrderedDict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_batches, materialise, table

#: Characters of a chunk: least, about, most; and of the rolling window. A cut needs CUT_BITS zero bits of the hash.
LEAST, CUT_BITS, MOST = 256, 10, 4096
WINDOW = 32
BLOCK = 1 << 20
#: 64-bit words of the filter of texts that have a shared chunk: 8 MB, whatever the input. Beyond some 15 million such
#: texts it lets others through as well, which then move without need.
FILTER_WORDS = 1 << 20
#: Words, their pieces, and results of whole texts that a worker keeps before it starts anew.
CACHE_WORDS, CACHE_PIECES, CACHE_TEXTS = 200_000, 400_000, 20_000


def _mixed(code: np.ndarray) -> np.ndarray:
    h = code * np.uint32(0x9E3779B1)
    h ^= h >> np.uint32(15)
    return h * np.uint32(0x85EBCA6B)


def cuts(text: str) -> list[int]:
    """Where the chunks of a text begin, and its end: [0, ..., len(text)]."""
    out, last, n = [0], 0, len(text)
    for at in range(0, n, BLOCK):
        lead = min(at, WINDOW)
        h = _mixed(np.frombuffer(text[at - lead : at + BLOCK].encode("utf-32-le", "surrogatepass"), np.uint32))
        w = 1
        while w < WINDOW and w < len(h):  # sums of twice as many characters at each step
            more = h.copy()
            more[w:] += h[:-w] << np.uint32(w)
            h, w = more, 2 * w
        for p in (np.flatnonzero(h[lead:] >> np.uint32(32 - CUT_BITS) == 0) + at + 1).tolist():
            while p - last > MOST:
                last += MOST
                out.append(last)
            if p - last >= LEAST and p < n:
                out.append(p)
                last = p
    while n - last > MOST:
        last += MOST
        out.append(last)
    if n:
        out.append(n)
    return out


def key(text: str) -> tuple[int, int]:
    """128 bits that tell texts apart, as two signed longs."""
    import xxhash

    d = xxhash.xxh3_128_digest(text.encode("utf-8", "surrogatepass"))
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


#: Fixed value: the split that the tokenizers file must have.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Byte-level BPE stands for the bytes that aren't visible characters by those from 256 on, in order.
VISIBLE = dict(zip((b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or b >= 174)), range(256, 512)))


class Codec:
    """A tokenizers file: ids of texts as little-endian unsigned 32-bit numbers.

    Spaces and newlines stand in no token and end every one of this kind of file, so the
    words between them are encoded by themselves and kept. New words of ASCII and common
    Latin letters, whose normal form and splits are plain, are cut here and their pieces go
    to the library's model; others go to the library whole. An added token's content has no
    white space, and words with one are others.
    """

    #: How the file splits a normalised word (of plain letters); and the letters taken as plain, of which
    #: each is its own normal form and has one lower-case letter, which is plain too.
    LETTERS = "a-zA-Z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff"
    SPLIT = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[0-9]|[!-/:-@\[-`{{-~]+")
    PLAIN = re.compile(rf"[!-~{LETTERS}]+")

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.known: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.names = [self.tokenizer.id_to_token(i) for i in range(size)]
        self.numbers = list(map(str, range(size)))

    @staticmethod
    def check(path: str) -> None:
        """Refuse files whose words aren't cut at white space or aren't decoded by joining tokens."""
        with open(path, encoding="utf-8") as f:
            d = json.load(f)
        kinds = [x["type"] for x in (d["normalizer"] or {}).get("normalizers", [])]
        splits = [x for x in (d["pre_tokenizer"] or {}).get("pretokenizers", []) if x["type"] == "Split"]
        whole = kinds == ["NFC", "Replace", "Lowercase"] and splits and splits[0]["behavior"] == "Removed" and splits[0]["invert"] and splits[0]["pattern"]["Regex"] == SPLIT
        odd = [t["content"] for t in d["added_tokens"] if t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] or any(c.isspace() for c in t["content"])]
        if not whole or odd or d.get("decoder") or d.get("post_processor"):
            raise ValueError("this tokenizer isn't of the kind that drops white space between words")

    def library(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, text: str) -> bytes:
        words = text.replace("\n", " ").split(" ")
        try:
            return b"".join(map(self.known.__getitem__, words))
        except KeyError:
            if len(self.known) > CACHE_WORDS:
                self.known.clear()
            self.learn({w for w in words if w not in self.known})
            return b"".join(map(self.known.__getitem__, words))

    def learn(self, words: set[str]) -> None:
        known, pieces, odd = self.known, self.pieces, []
        if len(pieces) > CACHE_PIECES:
            pieces.clear()
        for w in words:
            if not self.PLAIN.fullmatch(w) or any(t in w for t in self.added):
                odd.append(w)
                continue
            found = self.SPLIT.findall(w.lower())
            try:
                known[w] = b"".join(map(pieces.__getitem__, found))
            except KeyError:
                for p in found:
                    if p not in pieces:
                        pieces[p] = np.array([t.id for t in self.tokenizer.model.tokenize(p.encode().decode("latin-1").translate(VISIBLE))], "<u4").tobytes()
                known[w] = b"".join(map(pieces.__getitem__, found))
        for w, ids in zip(odd, self.library(odd) if odd else ()):
            known[w] = np.array(ids, "<u4").tobytes()

    def digests(self, ids: np.ndarray) -> tuple[int, str, str]:
        """How many ids there are, the digest of their decimal text, and that of the decoded text."""
        some = ids.tolist()
        sha = lambda names: hashlib.sha256(" ".join(map(names.__getitem__, some)).encode()).hexdigest()
        return len(some), sha(self.numbers), sha(self.names)

    def decode(self, ids: np.ndarray) -> str:
        return " ".join(map(self.names.__getitem__, ids.tolist()))

    # joins

    def joined(self, text: str, parts: list[tuple[int, int, bytes | None]]) -> np.ndarray:
        """The ids of a text from those of its parts (start, end, ids; None: not encoded yet).

        What is known of a part is replaced near each join by what a window around it
        gives. `done` are ids that are settled, which end at a word's end.
        """
        done, start, ids = b"", 0, b""  # ids are those of text[start:end] by its parts so far
        for a, b, given in parts:
            part = self.encode(text[a:b]) if given is None else given
            if a == start:
                ids = part
                end = b
                continue
            left, right = self._repaired(text, start, a, end := b, ids, part)
            done, start, ids = done + left[0], left[1], right
        return np.frombuffer(done + ids, "<u4")

    def _repaired(self, text: str, start: int, join: int, end: int, left: bytes, right: bytes) -> tuple[tuple[bytes, int], bytes]:
        """The settled ids before the window, where what follows begins, and its ids: of the window and the rest.

        The window takes 1, 2, 4, ... words on either side, and is accepted once the ids
        of its first word end what the left side gave before the join, and those of its
        last word begin the right side's, as the sides have them; or it reaches their ends.
        """
        k = 1
        while True:
            a, b = _back(text, start, join, k), _on(text, join, end, k)
            a2, b2 = _on(text, a, join, 0), _back(text, join, b, 0)  # ends of the outer words
            window = np.array(self.library([text[a:b]])[0], "<u4").tobytes()
            tail, head = self.encode(text[a:join]), self.encode(text[join:b])
            first, last = self.encode(text[a:a2]), self.encode(text[b2:b])
            agree_left = a == start or (a2 < join and tail.startswith(first) and window.startswith(first))
            agree_right = b == end or (b2 > join and head.endswith(last) and window.endswith(last))
            if agree_left and agree_right and left.endswith(tail) and right.startswith(head):
                keep = left[: len(left) - len(tail)]
                return (keep, a), window + right[len(head) :]
            if a == start and b == end:  # nothing is left to agree with: the window is all there is
                return (b"", start), window
            k *= 2


def _back(text: str, low: int, at: int, words: int) -> int:
    """Where the last `words` whole words before what stands at `at` begin: after a space or newline, or low."""
    for _ in range(words + 1):
        p = max(text.rfind(" ", low, at), text.rfind("\n", low, at))
        if p < 0:
            return low
        at = p
    return at + 1


def _on(text: str, at: int, high: int, words: int) -> int:
    """Where the first `words` whole words after what stands at `at` end: at a space or newline, or high."""
    for _ in range(words + 1):
        found = [p for p in (text.find(" ", at, high), text.find("\n", at, high)) if p >= 0]
        if not found:
            return high
        at = min(found) + 1
    return at - 1


@lru_cache(1)
def codec(path: str) -> Codec:
    """One for each worker process, whatever the number of its tasks."""
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    return Codec(path)


TEXT_KEY = ["t1", "t2"]
RESULT = "n_tokens long, ids_sha256 string, decoded_sha256 string"


def outlines(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Each text's key and the keys of its chunks, in order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            t, k, n = [], [], []
            for text in b.column(0).to_pylist():
                at = cuts(text or "")
                t.append(key(text or ""))
                k += [key(text[x:y]) for x, y in zip(at, at[1:])]
                n.append(len(at) - 1)
            t, k = np.array(t, np.int64).reshape(-1, 2), np.array(k, np.int64).reshape(-1, 2)
            chunks = pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(k[:, i])) for i in range(2)], ["k1", "k2"])
            offsets = pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32))
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(t[:, 0])), pa.array(np.ascontiguousarray(t[:, 1])), pa.ListArray.from_arrays(offsets, chunks)], ["t1", "t2", "chunks"])

    return docs.select(F.col(text_col).cast("string")).mapInArrow(run, "t1 long, t2 long, chunks array<struct<k1: long, k2: long>>")


def shared_chunks(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Where chunks stand that stand in several places of the distinct texts: t1, t2, pos, k1, k2
    and own (whether this text encodes the chunk)."""
    rows = materialise(outlines(docs, text_col).withColumn("row", F.monotonically_increasing_id()), "outlines")
    one = rows.groupBy(*TEXT_KEY).agg(F.min("row").alias("row")).select("row")
    places = materialise(rows.join(one, "row", "left_semi").select("row", *TEXT_KEY, F.posexplode("chunks").alias("pos", "k")).select("row", *TEXT_KEY, "pos", "k.k1", "k.k2"), "places")
    shared = places.groupBy("k1", "k2").agg(F.count("*").alias("n"), F.min("row").alias("owner")).filter("n > 1")
    # one chunk may stand in a third of all texts: adaptive execution splits this join
    return materialise(places.join(shared, ["k1", "k2"]).select(*TEXT_KEY, "pos", "k1", "k2", (F.col("row") == F.col("owner")).alias("own")), "shared_places")


def _filter(keys: DataFrame, words: int) -> np.ndarray:
    """Bits of two hashes of each key, in `words` 64-bit words (as many rows come to the driver at most)."""
    hashes = keys.select(F.explode(F.array(*TEXT_KEY)).alias("h"))
    word = F.pmod(F.shiftright("h", 6), F.lit(words)).cast("int").alias("word")
    bit = F.expr("shiftleft(1L, CAST(h & 63 AS INT))")
    found = hashes.groupBy(word).agg(F.bit_or(bit).alias("bits")).toArrow()
    out = np.zeros(words, np.int64)
    out[found.column("word").to_numpy()] = found.column("bits").to_numpy()
    return out


def _split(docs: DataFrame, keep: list, names: list[str], seen: np.ndarray, path: str) -> DataFrame:
    """Results of texts that share nothing; the text, once a task, of those that may."""
    words = len(seen)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        known: OrderedDict = OrderedDict()
        for b in batches:
            t1, t2, n, ids, decoded, moved = [], [], [], [], [], []
            for text in b.column(b.num_columns - 1).to_pylist():
                text = text or ""
                k = key(text)
                if k in known:
                    known.move_to_end(k)
                    result, text = known[k], None
                elif all(int(seen[(x >> 6) % words]) >> (x & 63) & 1 for x in k):
                    result = (None, None, None)
                else:
                    result, text = c.digests(np.frombuffer(c.encode(text), "<u4")), None
                known[k] = result
                if len(known) > CACHE_TEXTS:
                    known.popitem(last=False)
                for xs, x in zip((t1, t2, n, ids, decoded, moved), (*k, *result, text)):
                    xs.append(x)
            cells = [pa.array(t1, pa.int64()), pa.array(t2, pa.int64()), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string()), pa.array(moved, pa.string())]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], *cells], [*names, "t1", "t2", "n_tokens", "ids_sha256", "decoded_sha256", "moved"])

    rows = docs.select(*keep)
    types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return rows.mapInArrow(run, f"{types}, t1 long, t2 long, {RESULT}, moved string")


def _pieces(texts: DataFrame, path: str) -> DataFrame:
    """k1, k2, ids: the chunks that each text (with its marks) owns, encoded."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for b in batches:
            out = {}
            for text, marks in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                at = cuts(text)
                for m in marks:
                    if m["own"] and (m["k1"], m["k2"]) not in out:
                        out[m["k1"], m["k2"]] = c.encode(text[at[m["pos"]] : at[m["pos"] + 1]])
            k = np.array(list(out), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(k[:, 0])), pa.array(np.ascontiguousarray(k[:, 1])), pa.array(list(out.values()), pa.binary())], ["k1", "k2", "ids"])

    owned = texts.filter(F.exists("marks", lambda m: m.own)).select("text", "marks")
    return owned.mapInArrow(run, "k1 long, k2 long, ids binary")


def _assembled(texts: DataFrame, path: str) -> DataFrame:
    """t1, t2 and the results of texts, each with the ids of its shared chunks (pos, ids)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for b in batches:
            out = []
            for text, found in zip(b.column(2).to_pylist(), b.column(3).to_pylist()):
                at, parts, last = cuts(text), [], 0
                for m in sorted(found or [], key=lambda m: m["pos"]):
                    x, y = at[m["pos"]], at[m["pos"] + 1]
                    parts += [(last, x, None)] * (last < x) + [(x, y, m["ids"])]
                    last = y
                parts += [(last, len(text), None)] * (last < len(text))
                out.append(c.digests(c.joined(text, parts)))
            n, ids, decoded = zip(*out) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())], ["t1", "t2", "n_tokens", "ids_sha256", "decoded_sha256"])

    return texts.select("t1", "t2", "text", "found").mapInArrow(run, f"t1 long, t2 long, {RESULT}")


def encode(docs: DataFrame, tokenizer_path: str | None = None, id_col: str = "doc_id", text_col: str = "text", filter_words: int = FILTER_WORDS) -> DataFrame:
    """Every whole text's ids and decoded text, as digests: the id column, n_tokens, ids_sha256
    (of the decimal ids, joined by spaces) and decoded_sha256.

    A null text counts as empty and has no tokens; null ids and repeated rows stay; an
    empty table gives no rows; other columns are ignored. Equal texts are encoded once by
    a task, or once in all if they have a shared chunk.
    """
    import public_tokenizers

    path = tokenizer_path or public_tokenizers.path("word_bpe_49k.json")
    Codec.check(path)
    bounded_batches(docs.sparkSession)
    marks = shared_chunks(docs, text_col)
    seen = _filter(marks.select(*TEXT_KEY).distinct(), filter_words)
    keep = [F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")]
    rows = materialise(_split(docs, keep, ["id"], seen, path), "encoded")
    moved = rows.filter("moved IS NOT NULL").select(*TEXT_KEY, F.col("moved").alias("text")).dropDuplicates(TEXT_KEY)
    listed = marks.groupBy(*TEXT_KEY).agg(F.collect_list(F.struct("pos", "k1", "k2", "own")).alias("marks"))  # of one text
    texts = materialise(moved.join(listed, TEXT_KEY, "left"), "moved")
    pieces = materialise(_pieces(texts, path), "pieces")
    given = marks.join(pieces, ["k1", "k2"]).groupBy(*TEXT_KEY).agg(F.collect_list(F.struct("pos", "ids")).alias("found"))
    joined = materialise(_assembled(texts.drop("marks").join(given, TEXT_KEY, "left"), path), "joined")
    columns = [F.col("id").alias(id_col), "n_tokens", "ids_sha256", "decoded_sha256"]
    placed = rows.filter("n_tokens IS NOT NULL").select(*columns)
    # copies of one text may be a third of all rows: adaptive execution splits this join
    return placed.union(rows.filter("n_tokens IS NULL").select("id", *TEXT_KEY).join(joined, TEXT_KEY).select(*columns))


def op13_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(table(spark, sf_dir, "documents"))
