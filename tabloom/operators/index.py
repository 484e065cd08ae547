"""Search indexes as tables: postings for words, coarse cells for vectors.

The postings of a word stand in one of a fixed number of folders, by its hash, sorted by
word, so a query reads what its words have and no text. Documents are dealt to ranges of
about equal size; a posting row has a word's documents of one range, and the bounds that
a score in this range can't exceed, so that a top-k reads bounds first and then only the
ranges that can still matter. Scores are those of search.bm25.

Vectors are put into the cell of the nearest of a few thousand centres, which are the
result of k-means on a bounded sample; every vector is indexed. A query reads the cells
nearest to it, and ranks what it finds there exactly. How many cells that takes depends on
the vectors: few for those in clusters, most for those without any; it is measured.
"""

from __future__ import annotations

import json
import re

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.functions.text import tokens
from tabloom.session import materialise, ship

from .layout import _fs
from .search import K1, B, cosine

#: Folders of postings; documents of a range, about.
FOLDERS, RANGE_DOCS = 256, 4096
#: Ranges of a word that one task writes, about.
TASK_RANGES = 256
#: Centres of a vector index: the square root of the vectors, within these; vectors that they are fitted on at most, for
#: each centre; rounds. How many cells a query reads is measured for this recall, on so many queries of the sample.
CENTRES, SAMPLE_PER_CENTRE, ROUNDS = (1, 4096), 64, 8
RECALL, QUERIES = 0.97, 500


def _save(spark: SparkSession, path: str, value: dict) -> None:
    fs, p, _ = _fs(spark, path)
    out = fs.create(p, True)
    try:
        out.write(json.dumps(value).encode())
    finally:
        out.close()


def _load(spark: SparkSession, path: str) -> dict:
    fs, p, _ = _fs(spark, path)
    stream = fs.open(p)
    try:
        return json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def _folder(word: Column | str, folders: int) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(folders)).cast("int")


def word_counts(words: Column | str) -> Column:
    """The distinct words of a sorted array and how often each stands there: (word, tf)."""
    def counted(w: Column) -> Column:
        at = F.when(F.size(w) > 0, F.sequence(F.lit(0), F.size(w) - 1)).otherwise(F.array().cast("array<int>"))
        firsts = F.filter(at, lambda i: (i == 0) | (F.get(w, i) != F.get(w, i - 1)))
        return F.transform(F.array(firsts), lambda f: F.transform(f, lambda i, j: F.struct(F.get(w, i).alias("word"), (F.coalesce(F.get(f, j + 1), F.size(w)) - i).alias("tf"))))[0]

    return F.transform(F.array(F.col(words) if isinstance(words, str) else words), counted)[0]


def build_postings(df: DataFrame, id_col: str, text: str, path: str, folders: int = FOLDERS, range_docs: int = RANGE_DOCS) -> None:
    """Write the index of a table's texts to path.

    Each row is a document; a null text has no word and counts as one, as in search.bm25.
    Rows of one id stay apart.
    """
    spark = df.sparkSession
    n = df.count()
    ranges = max(1, -(-n // range_docs))
    docs = df.select(F.col(id_col).alias("id"), F.sort_array(tokens(text)).alias("w"), F.monotonically_increasing_id().alias("doc"))
    docs = docs.select("id", F.size("w").alias("len"), F.pmod(F.xxhash64("doc"), F.lit(ranges)).cast("int").alias("range"), F.explode(word_counts("w")).alias("c"))
    # words are counted where their document stands and are dealt once, to the task that writes them: no range
    # of a word is in two tasks, and a task's share of a frequent word is bounded
    parts = -(-ranges // TASK_RANGES)
    dealt = docs.select("c.word", "range", "id", "c.tf", "len", _folder("c.word", folders).alias("folder"), F.pmod("range", F.lit(parts)).alias("part")).repartition(folders * parts, "folder", "part")
    rows = dealt.groupBy("folder", "part", "word", "range").agg(  # about range_docs documents at most
        F.collect_list(F.struct("id", "tf", "len")).alias("docs"), F.max("tf").alias("most"), F.min("len").alias("least"), F.count("*").alias("n"), F.sum("tf").alias("words")
    )
    rows = rows.select("word", "range", "docs", "most", "least", "n", "words", "folder")
    rows.sortWithinPartitions("folder", "word", "range").write.mode("overwrite").option("compression", "zstd").option("parquet.block.size", 4 << 20).partitionBy("folder").parquet(f"{path}/postings")
    kind = df.select(F.col(id_col)).schema[0].dataType.simpleString()
    about = {"docs": n, "ranges": ranges, "folders": folders, "schema": f"word string, range int, docs array<struct<id: {kind}, tf: int, len: int>>, most int, least int, n long, words long, folder int"}
    words = spark.read.schema(about["schema"]).parquet(f"{path}/postings").agg(F.sum("words")).first()[0] or 0
    _save(spark, f"{path}/about.json", about | {"mean": words / max(1, n)})


def _words(query: str) -> list[str]:
    terms = list(dict.fromkeys(re.findall(r"[a-z0-9]+", query.lower())))
    if not terms:
        raise ValueError("the query has no word")
    return terms


def _gain(idf: Column, tf: Column, length: Column, mean: float, k1: float, b: float) -> Column:
    tf = tf.cast("double")
    return idf * tf * (k1 + 1) / (tf + k1 * (1 - b + b * length / F.lit(mean)))


def search_postings(spark: SparkSession, path: str, query: str, limit: int | None = 10, k1: float = K1, b: float = B) -> DataFrame:
    """The scores of search.bm25, read from the index: id and score, best first with a limit."""
    about, terms = _load(spark, f"{path}/about.json"), _words(query)
    postings = spark.read.schema(about["schema"]).parquet(f"{path}/postings").filter(F.col("word").isin(*terms))
    asked = spark.createDataFrame([(t,) for t in terms], "t string").select(_folder("t", about["folders"])).distinct().collect()  # of the query's words
    postings = postings.filter(F.col("folder").isin(*(r[0] for r in asked)))
    found = {r.word: r.n for r in postings.groupBy("word").agg(F.sum("n").alias("n")).collect()}
    idf = F.lit(0.0)
    for t, n in found.items():
        idf = F.when(F.col("word") == t, F.log(F.lit(1 + (about["docs"] - n + 0.5) / (n + 0.5)))).otherwise(idf)
    mean = about["mean"] or 1.0

    def scored(rows: DataFrame) -> DataFrame:
        each = rows.select(idf.alias("idf"), "range", F.posexplode("docs").alias("at", "d"))
        # a document's words stand in one range, so their sum is made by document
        return each.select("range", "d.id", "d.len", _gain(F.col("idf"), F.col("d.tf"), F.col("d.len"), mean, k1, b).alias("s")).groupBy("range", "id", "len").agg(F.sum("s").alias("score")).select("id", "score")

    top = lambda rows: rows.orderBy(F.desc("score"), F.asc("id")).limit(limit)
    if not limit:
        return scored(postings)
    bounds = materialise(postings.select("range", "n", _gain(idf, F.col("most"), F.col("least"), mean, k1, b).alias("s")).groupBy("range").agg(F.sum("s").alias("bound"), F.max("n").alias("n")), "bounds")
    first = bounds.orderBy(F.desc("bound")).limit(max(1, limit)).select("range")  # likely to have the best
    seen = top(scored(postings.join(F.broadcast(first), "range", "left_semi"))).agg(F.count("*"), F.min("score")).first()
    if seen[0] >= limit:  # no document of a range whose bound is lower can be among the best
        postings = postings.join(bounds.filter(F.col("bound") >= F.lit(seen[1] * (1 - 1e-9))).select("range"), "range", "left_semi")
    return top(scored(postings))


def build_cells(df: DataFrame, id_col: str, vector: str, path: str, centres: int | None = None, seed: int = 42) -> None:
    """Write a coarse index of a table's vectors to path: each vector in its nearest centre's cell.

    Vectors that are null, have a component that isn't finite or are zero have no cosine
    with anything and are left out. All must be of one length. The centres are fitted on
    at most SAMPLE_PER_CENTRE vectors for each, by hash; every vector is indexed.
    """
    spark = df.sparkSession
    ship(spark)
    v = F.col(vector).cast("array<double>")
    rows = df.select(F.col(id_col).alias("id"), v.alias("v")).filter(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists("v", lambda x: x != 0))
    n, schema = rows.count(), f"id {rows.schema['id'].dataType.simpleString()}, v array<double>, cell int"
    k = max(CENTRES[0], min(CENTRES[1], centres or int(n**0.5)))
    take = min(1.0, 2.0 * k * SAMPLE_PER_CENTRE / max(1, n))
    sample = rows.filter(F.pmod(F.xxhash64("v", F.lit(seed)), F.lit(1 << 30)) <= int(take * (1 << 30))).limit(k * SAMPLE_PER_CENTRE).select("v").toArrow()
    x = np.array(sample.column("v").to_pylist(), float)
    if not len(x):
        rows.withColumn("cell", F.lit(0)).write.mode("overwrite").partitionBy("cell").parquet(f"{path}/cells")
        return _save(spark, f"{path}/centres.json", {"centres": [], "probes": 0, "schema": schema})
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(ROUNDS):  # spherical k-means on the bounded sample
        near = (x @ c.T).argmax(axis=1)
        sums = np.zeros_like(c)
        np.add.at(sums, near, x)
        size = np.linalg.norm(sums, axis=1, keepdims=True)
        c = np.where(size > 0, sums / np.where(size > 0, size, 1), c)

    def cells(frames):
        for f in frames:
            y = np.array(f["v"].tolist(), float).reshape(len(f), -1)
            f["cell"] = (y @ c.T).argmax(axis=1).astype("int32")
            yield f

    placed = rows.mapInPandas(cells, f"id {rows.schema['id'].dataType.simpleString()}, v array<double>, cell int")
    spread = F.pmod(F.xxhash64("id"), F.lit(8))  # a cell may have a third of all vectors
    placed.repartition("cell", spread).sortWithinPartitions("cell").write.mode("overwrite").option("compression", "zstd").partitionBy("cell").parquet(f"{path}/cells")
    _save(spark, f"{path}/centres.json", {"centres": c.tolist(), "probes": _probes(x, c), "schema": schema})


def _probes(x: np.ndarray, c: np.ndarray) -> int:
    """How many of a query's nearest cells hold RECALL of its ten nearest, as measured on the sample."""
    q = x[: min(len(x), QUERIES)]
    order = np.argsort(np.argsort(-(q @ c.T), axis=1, kind="stable"), axis=1)  # the rank of each cell for each query
    nearest = np.argsort(-(q @ x.T), axis=1, kind="stable")[:, :10]
    ranks = np.take_along_axis(order, (x @ c.T).argmax(axis=1)[nearest], axis=1)
    return int(np.quantile(ranks, RECALL, method="higher")) + 1


def search_cells(spark: SparkSession, path: str, query: list[float], limit: int = 10, probes: float | int | None = None) -> DataFrame:
    """The nearest vectors by cosine among those of the cells nearest to the query: id and score.

    probes is a share of the cells, or how many; 1.0 reads all, and is the exact way. By
    default it is what the build has measured to reach a recall of RECALL.
    """
    about = _load(spark, f"{path}/centres.json")
    c, probes = np.array(about["centres"], float), about["probes"] if probes is None else probes
    cells = spark.read.schema(about["schema"]).parquet(f"{path}/cells")
    if len(c) and probes != 1.0:
        many = max(1, min(len(c), probes if isinstance(probes, int) else int(np.ceil(probes * len(c)))))
        best = np.argsort(-(c @ np.array(query, float)), kind="stable")[:many]
        cells = cells.filter(F.col("cell").isin(*best.tolist()))
    q = F.array(*(F.lit(float(x)) for x in query))
    return cells.select("id", cosine(F.col("v"), q).alias("score")).filter("score IS NOT NULL").orderBy(F.desc("score"), F.asc("id")).limit(limit)
