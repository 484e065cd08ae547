"""Language identification of words by a linear-chain conditional random field.

A word's features are itself (the lexicon), its affixes and its letter n-grams, hashed;
transitions between languages are learned from code-switched sequences made of labelled
texts. Forward-backward gives each word's probability of each language; a document gets
the mean over all its words. A batch of documents is one sequence with resets, run in
many chains at once: each chain's transfer matrix is found first, so that the result is
that of one exact pass.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import bounded_batches, table

#: The bounds of the training sample: rows of each language, rows of all (shared evenly), and words taken of a row.
ROWS_PER_LANGUAGE, SAMPLE_ROWS, WORDS_PER_ROW = 800, 160_000, 120
BUCKETS = 1 << 17
#: Up to so many languages chains are cut anywhere, which costs the cube of their number.
FEW = 16
#: A run of more letters is taken as several words, one after the other.
WIDTH = 24
#: Runs of letters, and of numerals that aren't digits; and the marks, such as vowel signs, that belong to the letter before.
RUNS = re.compile(r"[^\W\d_]+")
MARKED, MARK = regex.compile(r"[\p{L}\p{N}--\p{Nd}][\p{L}\p{M}\p{N}--\p{Nd}]*", regex.V1), regex.compile(r"\p{M}")
HELD_OUT = 2


def letter_runs(text: str) -> list[str]:
    """The words of a text: runs of letters (numerals such as a half sign are none), in
    pieces of at most WIDTH."""
    if not text.isascii() and MARK.search(text):
        runs = ("".join(c if c.isalpha() or MARK.match(c) else " " for c in w).split() for w in MARKED.findall(text))
        runs = (r for rs in runs for r in rs if not MARK.match(r[0]))
        return [r[k : k + WIDTH] for r in runs for k in range(0, len(r), WIDTH)]
    found = RUNS.findall(text)
    if all(map(str.isalpha, found)) and max(map(len, found), default=0) <= WIDTH:
        return found
    runs = (r for w in found for r in ([w] if w.isalpha() else "".join(c if c.isalpha() else " " for c in w).split()))
    return [r[k : k + WIDTH] for r in runs for k in range(0, len(r), WIDTH)]


def feature_ids(words: list[str]) -> np.ndarray:
    """Hashed features of each word of at most WIDTH letters, padded with BUCKETS: identity,
    prefixes of 1 to 3 letters, suffixes of 1 to 4, bigrams and trigrams with word ends."""
    text = np.array(words, f"U{WIDTH}")
    code = np.zeros((len(words), WIDTH + 2), np.uint32)
    code[:, 1:-1] = text.view(np.uint32).reshape(len(words), WIDTH)
    size = (code != 0).sum(axis=1)
    row = np.arange(len(words))
    code[:, 0] = 1
    code[row, size + 1] = 2

    def bucket(kind: int, *parts: np.ndarray) -> np.ndarray:
        h = np.full(parts[0].shape, kind * 0x9E3779B1 & 0xFFFFFFFF, np.uint32)
        for p in parts:
            h = (h ^ p) * np.uint32(0x85EBCA6B)
            h ^= h >> np.uint32(15)
        return (h * np.uint32(0xC2B2AE35) >> np.uint32(15)).astype(np.int32)

    end = size + 1  # where the end mark stands
    back = lambda k: code[row, np.maximum(end - k, 0)]
    out = [bucket(1, *code.T)]
    out += [np.where(size >= k, bucket(1 + k, *code[:, 1 : k + 1].T), BUCKETS) for k in (1, 2, 3)]
    out += [np.where(size >= k, bucket(4 + k, *(back(j) for j in range(k, 0, -1))), BUCKETS) for k in (1, 2, 3, 4)]
    longest = int(size.max(initial=0)) + 2
    for k in (2, 3):
        at = np.arange(longest - k + 1)
        grams = bucket(8 + k, *(code[:, at + j] for j in range(k)))
        out += list(np.where(at[None] + k - 1 <= end[:, None], grams, BUCKETS).T)
    return np.stack(out, axis=1)


@dataclass(frozen=True)
class Crf:
    languages: tuple[str, ...]
    weights: np.ndarray  # (BUCKETS + 1, languages), the last row zero
    start: np.ndarray
    transitions: np.ndarray  # [from, to]

    def emissions(self, words: list[str], step: int = 8192) -> np.ndarray:
        parts = [self.weights[feature_ids(words[a : a + step])].sum(axis=1) for a in range(0, len(words), step)]
        return np.concatenate(parts) if parts else np.zeros((0, len(self.languages)), np.float32)

    def marginals(self, emissions: np.ndarray, first: np.ndarray) -> np.ndarray:
        """P(language) of each word; first marks the words that begin a sequence.

        Vectors are rescaled at every step, as only their directions matter. Chains cut
        anywhere cost the cube of the number of languages, so with many of them each
        sequence is a chain.
        """
        n, k = emissions.shape
        if k > FEW:
            return self._by_sequence(emissions, first)
        steps = max(1, int(np.sqrt(n)))
        chains = -(-n // steps)
        pad = steps * chains - n
        b = np.exp(emissions - emissions.max(axis=1, keepdims=True)).astype(np.float64) + 1e-12
        b = np.concatenate([b, np.ones((pad, k))]).reshape(chains, steps, k).transpose(1, 0, 2)
        reset = np.concatenate([first, np.ones(pad, bool)]).reshape(chains, steps).T
        a, pi = np.exp(self.transitions), np.exp(self.start)
        scale = lambda x, axes: x / x.max(axis=axes, keepdims=True)
        any_reset = reset.any(axis=1)

        whole = np.broadcast_to(np.eye(k), (chains, k, k)).copy()
        for s in range(steps):
            nxt = whole @ a
            if any_reset[s]:
                nxt = np.where(reset[s][:, None, None], whole.sum(axis=2, keepdims=True) * pi, nxt)
            whole = scale(nxt * b[s][:, None], (1, 2))
        into, onto = np.ones((chains, k)), np.ones((chains, k))
        for c in range(1, chains):
            v = into[c - 1] @ whole[c - 1]
            into[c] = v / v.max()
        for c in range(chains - 2, -1, -1):
            v = whole[c + 1] @ onto[c + 1]
            onto[c] = v / v.max()

        forward = np.empty((steps, chains, k))
        v = into
        for s in range(steps):
            nxt = v @ a
            if any_reset[s]:
                nxt = np.where(reset[s][:, None], pi, nxt)
            forward[s] = v = scale(nxt * b[s], 1)
        v = onto
        for s in range(steps - 1, -1, -1):
            forward[s] *= v
            nxt = (b[s] * v) @ a.T
            if any_reset[s]:
                nxt = np.where(reset[s][:, None], 1.0, nxt)
            v = scale(nxt, 1)
        out = forward.transpose(1, 0, 2).reshape(-1, k)[:n]
        return out / out.sum(axis=1, keepdims=True)


    def _by_sequence(self, emissions: np.ndarray, first: np.ndarray) -> np.ndarray:
        """The same with a chain for each sequence, the longest first, so that at every step a run of them goes on."""
        at = np.flatnonzero(first)
        size = np.diff(np.append(at, len(emissions)))
        order = np.argsort(-size, kind="stable")
        at, size = at[order], size[order]
        b = np.exp(emissions - emissions.max(axis=1, keepdims=True)).astype(np.float64) + 1e-12
        a, pi = np.exp(self.transitions), np.exp(self.start)
        going = np.searchsorted(-size, -np.arange(size.max()), side="left")  # chains longer than each step
        out = np.empty_like(b)
        for t, m in enumerate(going):
            v = (pi if t == 0 else v[:m] @ a) * b[at[:m] + t]
            v /= v.max(axis=1, keepdims=True)
            out[at[:m] + t] = v
        back = np.ones((len(at), b.shape[1]))
        for t in range(len(going) - 1, -1, -1):
            m, rows = going[t], at[: going[t]] + t
            out[rows] *= back[:m]
            v = (b[rows] * back[:m]) @ a.T
            back[:m] = v / v.max(axis=1, keepdims=True)
        return out / out.sum(axis=1, keepdims=True)


def train(texts: list[list[str]], label: list[int], languages: tuple[str, ...], steps: int = 160, batch: int = 48, length: int = 96, seed: int = 7) -> Crf:
    """Fit on sequences that switch between texts every 4 to 40 words (Adagrad on the likelihood)."""
    k = len(languages)
    rng = np.random.default_rng(seed)
    vocabulary: dict[str, int] = {}
    coded = [np.array([vocabulary.setdefault(w, len(vocabulary)) for w in t], np.int64) for t in texts]
    ids = feature_ids(list(vocabulary))
    by_language = [[i for i, y in enumerate(label) if y == j and len(coded[i])] for j in range(k)]
    usable = [j for j in range(k) if by_language[j]]
    w, w2 = np.zeros((BUCKETS + 1, k), np.float32), np.full((BUCKETS + 1, k), 1e-2, np.float32)
    start, trans = np.zeros(k), np.zeros((k, k))
    s2, t2 = np.full(k, 1e-2), np.full((k, k), 1e-2)
    for _ in range(steps):
        word, gold = np.empty((batch, length), np.int64), np.empty((batch, length), np.int64)
        for r in range(batch):
            at = 0
            while at < length:
                j = usable[rng.integers(len(usable))]
                t = coded[by_language[j][rng.integers(len(by_language[j]))]]
                n = int(rng.integers(4, 41))
                a = int(rng.integers(0, max(1, len(t) - n + 1)))
                part = t[a : a + n][: length - at]
                word[r, at : at + len(part)], gold[r, at : at + len(part)] = part, j
                at += len(part)
        f = ids[word.ravel()]
        e = w[f].sum(axis=1)
        q = np.exp(e - e.max(axis=1, keepdims=True)).astype(np.float64).reshape(batch, length, k) + 1e-12
        a = np.exp(trans)
        forward, back = _forward(q, a, np.exp(start)), _backward(q, a)
        pm = forward * back
        pm /= pm.sum(axis=2, keepdims=True)
        p = pm.reshape(-1, k)
        one = np.zeros_like(p)
        one[np.arange(len(p)), gold.ravel()] = 1
        g = (p - one).astype(np.float32) / batch
        flat = f.ravel()
        grad = np.stack([np.bincount(flat, np.repeat(g[:, j], f.shape[1]), BUCKETS + 1) for j in range(k)], axis=1).astype(np.float32)
        grad += 1e-4 * w
        grad[-1] = 0
        w2 += grad * grad
        w -= 0.1 * grad / np.sqrt(w2)
        # pairs of neighbours, expected less observed
        x, z = forward[:, :-1].reshape(-1, k), (q * back)[:, 1:].reshape(-1, k)
        expected = a * ((x / ((x @ a) * z).sum(axis=1, keepdims=True)).T @ z)
        seen = np.zeros((k, k))
        y = gold
        np.add.at(seen, (y[:, :-1].ravel(), y[:, 1:].ravel()), 1)
        gt = (expected - seen) / batch + 1e-3 * trans
        t2 += gt * gt
        trans = trans - 0.1 * gt / np.sqrt(t2)
        gs = pm[:, 0].mean(axis=0) - np.bincount(gold[:, 0], minlength=k) / batch
        s2 += gs * gs
        start = start - 0.1 * gs / np.sqrt(s2)
    return Crf(languages, w, start, trans)


def _forward(q: np.ndarray, a: np.ndarray, pi: np.ndarray) -> np.ndarray:
    """Forward vectors of a batch, each scaled."""
    out = np.empty_like(q)
    for t in range(q.shape[1]):
        v = (pi if t == 0 else out[:, t - 1] @ a) * q[:, t]
        out[:, t] = v / v.max(axis=1, keepdims=True)
    return out


def _backward(q: np.ndarray, a: np.ndarray) -> np.ndarray:
    """Backward vectors of a batch, each scaled."""
    out = np.ones_like(q)
    for t in range(q.shape[1] - 2, -1, -1):
        v = (q[:, t + 1] * out[:, t + 1]) @ a.T
        out[:, t] = v / v.max(axis=1, keepdims=True)
    return out


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Crf:
    """Train on at most ROWS_PER_LANGUAGE rows of each language (fewer where that makes more
    than SAMPLE_ROWS in all), by hash, among those that aren't held out nor without an id.
    Texts without a letter teach nothing and don't count. Every other language with a row is learned; ties in the hash take any of the rows."""
    spark = docs.sparkSession
    bounded_batches(spark)
    usable = docs.select(F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    usable = usable.filter(~held_out("id") & F.col("id").isNotNull() & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    count = {r.lang: r["count"] for r in usable.groupBy("lang").count().collect()}  # a row for each language
    languages = tuple(sorted(count))
    if not languages:
        return Crf((), np.zeros((BUCKETS + 1, 0)), np.zeros(0), np.zeros((0, 0)))
    each = max(1, min(ROWS_PER_LANGUAGE, SAMPLE_ROWS // len(languages)))
    # hashes under a language's threshold are a few more rows than are needed, in one scan; the least of them are taken
    whole = 1 << 30
    share = [(x, min(whole, int(whole * (each + 6 * each**0.5 + 20) / n) + 1)) for x, n in count.items()]
    some = usable.withColumn("k", F.xxhash64("id", "text")).join(F.broadcast(spark.createDataFrame(share, "lang string, upto long")), "lang").filter(F.pmod("k", F.lit(whole)) < F.col("upto"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [letter_runs(t.lower()) for t in b.column(1).to_pylist()]
            spread = [w if len(w) <= WORDS_PER_ROW else _parts(w) for w in found]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(spread, pa.list_(pa.string()))], ["lang", "words"])

    place = F.row_number().over(Window.partitionBy("lang").orderBy("k"))
    rows = some.withColumn("place", place).filter(F.col("place") <= each).select("lang", "text").mapInArrow(cut, "lang string, words array<string>").collect()
    rows.sort(key=lambda r: (r.lang, r.words))
    rows = [r for r in rows if r.words]
    languages = tuple(sorted({r.lang for r in rows}))
    if not languages:
        return Crf((), np.zeros((BUCKETS + 1, 0)), np.zeros(0), np.zeros((0, 0)))
    number = {x: i for i, x in enumerate(languages)}
    return train([r.words for r in rows], [number[r.lang] for r in rows], languages)


def _parts(w: list[str], parts: int = 4) -> list[str]:
    """Runs from the beginning to the end of a long text, WORDS_PER_ROW words in all."""
    n = WORDS_PER_ROW // parts
    return [x for i in range(parts) for x in w[(len(w) - n) * i // (parts - 1) :][:n]]


def held_out(id_col: str):
    """crc32 of the id as text leaves 2 when divided by 4; false for null."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == HELD_OUT, F.lit(False))


def identify(docs: DataFrame, crf: Crf, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The language of every whole text: the id column, held_out, lang_pred and score.

    lang_pred has the greatest mean probability over the words (runs of letters, lower
    case; a run of over WIDTH letters is several words), score is that mean; a null text, one without a letter, or an untrained model
    gives 'und' and 0. Null ids and repeated rows stay; an empty table gives no rows;
    other columns are ignored. Ties go to the first language of the alphabet.
    """
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col), held_out(id_col).alias("held_out"), F.col(text_col).cast("string").alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pandas as pd

        for b in batches:
            pred, score = ["und"] * b.num_rows, np.zeros(b.num_rows)
            held: list[tuple[int, list[str]]] = []
            size = 0

            def label() -> None:
                codes, unique = pd.factorize(np.array([w for _, ws in held for w in ws], object))
                at = np.cumsum([0] + [len(ws) for _, ws in held[:-1]])
                first = np.zeros(len(codes), bool)
                first[at] = True
                p = crf.marginals(crf.emissions(list(unique))[codes], first)
                mean = np.add.reduceat(p, at) / np.diff(np.append(at, len(codes)))[:, None]
                for (i, _), m in zip(held, mean):
                    pred[i], score[i] = crf.languages[m.argmax()], min(1.0, m.max())

            for i, text in enumerate(b.column(2).to_pylist()):
                ws = letter_runs(text.lower()) if text and crf.languages else []
                if ws:
                    held.append((i, ws))
                    size += len(ws)
                if size * len(crf.languages) > 1_000_000:
                    label()
                    held, size = [], 0
            if held:
                label()
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(pred), pa.array(score)], [id_col, "held_out", "lang_pred", "score"])

    return rows.mapInArrow(run, f"`{id_col}` {rows.schema[0].dataType.simpleString()}, held_out boolean, lang_pred string, score double")


def op4_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return identify(docs, fit(docs))
