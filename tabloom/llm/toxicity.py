"""Toxicity grades by cumulative-link ordinal regression on sparse text features.

P(grade <= k) = sigmoid(threshold_k - w.x) with one weight vector for all ordered
thresholds. The model is fitted on a bounded sample of labelled rows; every document
is then scored whole, in Arrow batches.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_batches, materialise, table

#: The bound of the training sample: so many labelled rows of each class.
SAMPLE_ROWS = 2500
#: Features that are kept: those so many times as frequent in toxic texts as in others, by chi-square.
MAX_FEATURES = 1000
MIN_CHI2, MIN_RATIO, MIN_TEXTS = 20.0, 6.0, 8
#: Features at least so many times as frequent in toxic texts are telling: words with one are counted together, and so are words with others only.
TELLING_RATIO = 20.0
#: Grades: 0 is not toxic, 1 to 3 are toxic texts by thirds of their number of words that have any of the features.
GRADES = 4
#: Words whose chosen features a task keeps before it starts anew.
CACHE_WORDS = 150_000
WORD = re.compile(r"[^\W\d_]+")


def counts(text: str | None) -> Counter:
    """Counts of a text's words, in lower case."""
    return Counter(WORD.findall(text.lower())) if text else Counter()


def features_of(word: str) -> list[str]:
    """A word's own features: itself and its stems of four and five letters."""
    return [f"w {word}", *(f"{k} {word[:k]}" for k in (4, 5) if len(word) >= k)]


def sparse(c: Counter, chosen: dict[str, bool], known: dict[str, list[str]]) -> tuple[Counter, int, int]:
    """Counts of a text's chosen features (true for those that are telling), of its words
    with a telling one, and of its words with others only. known: the words' chosen features so far."""
    out, telling, other = Counter(), 0, 0
    if len(known) > CACHE_WORDS:
        known.clear()
    for w, n in c.items():
        found = known.get(w)
        if found is None:
            found = known[w] = [f for f in features_of(w) if f in chosen]
        if found:
            for f in found:
                out[f] += n
            if any(chosen[f] for f in found):
                telling += n
            else:
                other += n
    return out, telling, other


@dataclass(frozen=True)
class Model:
    features: tuple[str, ...]
    telling: tuple[bool, ...]
    weights: np.ndarray  # one for each feature, then those of words with telling and with other features
    thresholds: np.ndarray  # ascending

    def score(self, c: Counter, chosen: dict[str, bool], index: dict[str, int], known: dict[str, list[str]]) -> float:
        """w.x of a text's sparse features, the logarithms of their counts."""
        found, telling, other = sparse(c, chosen, known)
        x = sum(self.weights[index[f]] * math.log1p(n) for f, n in found.items())
        return float(x + self.weights[-2] * math.log1p(telling) + self.weights[-1] * math.log1p(other))

    def probabilities(self, score: np.ndarray) -> np.ndarray:
        """P(grade = k), a row for each score."""
        z = np.clip(self.thresholds[None] - score[:, None], -500, 500)
        below = np.hstack([np.zeros((len(score), 1)), 1 / (1 + np.exp(-z)), np.ones((len(score), 1))])
        return np.diff(below, axis=1)


def fit_ordinal(x: np.ndarray, y: np.ndarray, weight: np.ndarray, n_grades: int, l2: float = 1.0, steps: int = 600) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ascending thresholds by gradient steps (Adam) on the weighted likelihood."""
    n, d = x.shape
    share = np.cumsum(np.bincount(y, weight, n_grades))[:-1] / weight.sum()
    share = np.clip(share, 1e-3, 1 - 1e-3)
    start = np.log(share / (1 - share))
    p = np.concatenate([np.zeros(d), start[:1], np.log(np.maximum(np.diff(start), 1e-2))])
    m, v = np.zeros_like(p), np.zeros_like(p)
    one = np.arange(n)
    for t in range(1, steps + 1):
        gaps = np.exp(np.minimum(p[d + 1 :], 20))
        theta = p[d] + np.concatenate([[0.0], np.cumsum(gaps)])
        z = np.clip(theta[None] - (x @ p[:d])[:, None], -500, 500)
        s = np.hstack([np.zeros((n, 1)), 1 / (1 + np.exp(-z)), np.ones((n, 1))])
        likely = np.maximum(s[one, y + 1] - s[one, y], 1e-12)
        slope = s * (1 - s)  # zero at both ends
        dtheta = np.zeros((n, n_grades + 1))
        dtheta[one, y + 1] += slope[one, y + 1] / likely
        dtheta[one, y] -= slope[one, y] / likely
        dtheta *= weight[:, None]
        inner = dtheta[:, 1:-1]
        g_theta = inner.sum(axis=0)
        g = np.concatenate([-(x.T @ inner.sum(axis=1)) - l2 * p[:d], [g_theta.sum()], np.cumsum(g_theta[::-1])[::-1][1:] * gaps])
        g /= n
        m = 0.9 * m + 0.1 * g
        v = 0.999 * v + 0.001 * g * g
        p = p + 0.05 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return p[:d], p[d] + np.concatenate([[0.0], np.cumsum(np.exp(np.minimum(p[d + 1 :], 20)))])


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, max_features: int = MAX_FEATURES, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """Fit on at most sample_rows toxic and as many other labelled texts, by hash of their ids.

    A label above 0 is toxic; labels that are null, or of ids without a document with a text,
    don't count; an id with several labels counts with the largest, an id with several texts
    with the least of them. Without both classes the model grades everything 0.
    """
    bounded_batches(docs.sparkSession)
    known = labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg((F.max(label_col) > 0).alias("toxic"))
    there = docs.filter(F.col(text_col).isNotNull()).select(F.col(id_col).alias("id"))
    known = materialise(known.join(there, "id", "left_semi"), "labelled")  # before anything is counted or sampled
    total = {r.toxic: r["count"] for r in known.groupBy("toxic").count().collect()}
    never = Model((), (), np.zeros(2), np.array([30.0, 31.0, 32.0]))
    if len(total) < 2:
        return never
    parts = [known.filter(F.col("toxic") == t).orderBy(F.xxhash64("id"), "id").limit(sample_rows) for t in (True, False)]
    sample = parts[0].union(parts[1])  # at most 2 * sample_rows ids
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).join(F.broadcast(sample), "id").filter(F.col("text").isNotNull())
    rows = rows.groupBy("id", "toxic").agg(F.min("text").alias("text"))  # as few as the sample has ids, however often they repeat

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for toxic, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                f = list({f for w in counts(text) for f in features_of(w)})
                yield pa.RecordBatch.from_arrays([pa.array([toxic] * len(f), pa.bool_()), pa.array(f, pa.string())], ["toxic", "feature"])

    n_toxic, n_clean = (min(sample_rows, total[t]) for t in (True, False))
    a, b = F.col("a"), F.col("b")  # documents of either class that have the feature
    n, least = float(n_toxic + n_clean), max(3, min(MIN_TEXTS, n_toxic // 25))
    chi2 = n * (a * (n_clean - b) - b * (n_toxic - a)) ** 2 / (float(n_toxic) * n_clean * (a + b) * (n - a - b + 1.0))
    best = (
        rows.select("toxic", "text").mapInArrow(explode, "toxic boolean, feature string")
        .groupBy("feature").agg(F.sum(F.col("toxic").cast("double")).alias("a"), F.sum((~F.col("toxic")).cast("double")).alias("b"))
        .filter((a + b >= least) & ((a + 0.5) / (n_toxic + 1) >= MIN_RATIO * (b + 0.5) / (n_clean + 1)))
        .withColumn("chi2", chi2).filter(F.col("chi2") >= MIN_CHI2)
        .orderBy(F.desc("chi2"), "feature").limit(max_features).collect()
    )
    if not best:
        return never
    features = tuple(sorted(r.feature for r in best))
    index = {f: i for i, f in enumerate(features)}
    ratio = {r.feature: (r.a + 0.5) / (n_toxic + 1) / ((r.b + 0.5) / (n_clean + 1)) for r in best}
    chosen = {f: ratio[f] >= TELLING_RATIO for f in features}

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict = {}
        for b in batches:
            found = [sparse(counts(text), chosen, known) for text in b.column(1).to_pylist()]
            at, x = [[index[f] for f in c] for c, _, _ in found], [list(c.values()) for c, _, _ in found]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(at, pa.list_(pa.int32())), pa.array(x, pa.list_(pa.int32())), pa.array([t for _, t, _ in found], pa.int64()), pa.array([o for _, _, o in found], pa.int64())],
                ["toxic", "at", "n", "telling", "other"],
            )

    # at most 2 * sample_rows sparse rows
    data = rows.select("toxic", "text").mapInArrow(vectors, "toxic boolean, at array<int>, n array<int>, telling long, other long").collect()
    if not data:
        return never
    x = np.zeros((len(data), len(features) + 2))
    for i, r in enumerate(data):
        x[i, r.at] = np.log1p(r.n)
        x[i, -2:] = np.log1p([r.telling, r.other])
    hits = np.array([r.telling + r.other for r in data])
    toxic = np.array([r.toxic for r in data])
    y = np.zeros(len(data), np.int64)
    if toxic.any():
        some = hits[toxic & (hits > 0)]
        cuts = np.quantile(some if len(some) else [1], [k / (GRADES - 1) for k in range(1, GRADES - 1)])
        y[toxic] = 1 + np.searchsorted(cuts, hits[toxic], side="right")
    weight = np.where(toxic, total[True] / n_toxic, total[False] / n_clean)  # as frequent as among all labels
    weight *= len(weight) / weight.sum()
    w, theta = fit_ordinal(x, y, weight, GRADES)
    return Model(features, tuple(chosen.values()), w, theta)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Grade of every whole text: the id column, grade (the likeliest), expected_severity
    (0 to 3), p_toxic (probability of a grade above 0) and toxic (p_toxic of 0.5 or more).

    A null or empty text has no features and gets what the thresholds alone give; null
    ids and repeated rows stay; an empty table gives no rows; other columns are ignored.
    Of grades that are equally likely the lowest is given.
    """
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("__text"))
    run = _scorer(model, [id_col])
    return rows.mapInArrow(run, f"`{id_col}` {rows.schema[0].dataType.simpleString()}, grade int, expected_severity double, p_toxic double, toxic boolean")


def _scorer(model: Model, keep: list[str]):
    index, chosen = {f: i for i, f in enumerate(model.features)}, dict(zip(model.features, model.telling))
    known: dict = {}  # each task's own

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = [model.score(counts(text), chosen, index, known) for text in b.column(b.num_columns - 1).to_pylist()]
            p = model.probabilities(np.array(s))
            toxic = 1 - p[:, 0]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:-1], pa.array(p.argmax(axis=1).astype(np.int32)), pa.array(p @ np.arange(p.shape[1])), pa.array(toxic), pa.array(toxic >= 0.5)],
                [*keep, "grade", "expected_severity", "p_toxic", "toxic"],
            )

    return run


def clean(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of docs that aren't toxic, with their own columns only.

    Each row goes or stays by its own text; null ids and repeated rows are rows like
    others; a null or empty text has no features and stays, unless the thresholds alone
    say toxic; an empty table gives no rows; columns of any name stay as they are.
    """
    bounded_batches(docs.sparkSession)
    names = [f"c{i}" for i in range(len(docs.columns))]
    rows = docs.toDF(*names)
    schema = ", ".join(f"{n} {f.dataType.simpleString()}" for n, f in zip(names, docs.schema))
    grade = _scorer(model, names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            graded = next(grade(iter([pa.RecordBatch.from_arrays([*b.columns, b.column(names[docs_text])], [*names, "__text"])])))
            yield b.filter(pa.compute.invert(graded.column("toxic")))

    import pyarrow.compute  # noqa: F401

    docs_text = docs.columns.index(text_col)
    return rows.mapInArrow(run, schema).toDF(*docs.columns)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score(docs, fit(docs, table(spark, sf_dir, "labels")))
