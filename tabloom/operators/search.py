"""Search: keywords, BM25, vectors, and their fusion."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tabloom.functions.text import search_any, tokens

K1, B, RRF_K = 1.2, 0.75, 60


def keyword_search(df: DataFrame, columns: list[str], needle: str, limit: int | None = None) -> DataFrame:
    """Rows that hold the needle, case ignored, in any column."""
    found = df.filter(search_any(columns, needle))
    return found.limit(limit) if limit else found


def scoped_search(df: DataFrame, needle: str, text: str, equals: dict[str, object] | None = None, between: dict[str, tuple] | None = None) -> DataFrame:
    """Keyword search after equality and range predicates that reach the scan."""
    for c, v in (equals or {}).items():
        df = df.filter(F.col(c) == v)
    for c, (low, high) in (between or {}).items():
        df = df.filter((F.col(c) >= low) & (F.col(c) < high))
    return df.filter(search_any([text], needle))


def bm25(df: DataFrame, id_col: str, text: str, query: str, limit: int | None = 10, k1: float = K1, b: float = B) -> DataFrame:
    """Scores of the documents that hold any word of the query: id and score.

    Only the query's words are counted in each document, so the text is never exploded;
    document frequencies, number and mean length are one aggregate over all rows.
    """
    import re

    terms = list(dict.fromkeys(re.findall(r"[a-z0-9]+", query.lower())))
    if not terms:
        raise ValueError("the query has no word")
    count = lambda w, t: F.size(F.filter(w, lambda x: x == t))
    # generated, so that the words are made once a row, whatever names the counts
    counted = df.select(id_col, F.inline(F.transform(F.array(tokens(text)), lambda w: F.struct(F.size(w).alias("__len"), *(count(w, t).alias(f"__tf{i}") for i, t in enumerate(terms))))))
    stats = counted.agg(F.count("*").alias("__n"), F.avg("__len").alias("__avg"), *(F.count_if(F.col(f"__tf{i}") > 0).alias(f"__df{i}") for i in range(len(terms))))
    joined = counted.filter(" OR ".join(f"__tf{i} > 0" for i in range(len(terms)))).crossJoin(F.broadcast(stats))  # one row of statistics
    score = F.lit(0.0)
    for i in range(len(terms)):
        tf, df_ = F.col(f"__tf{i}").cast("double"), F.col(f"__df{i}").cast("double")
        idf = F.log(1 + (F.col("__n") - df_ + 0.5) / (df_ + 0.5))
        score = score + idf * tf * (k1 + 1) / (tf + k1 * (1 - b + b * F.col("__len") / F.col("__avg")))
    out = joined.select(id_col, score.alias("score"))
    return out.orderBy(F.desc("score"), F.asc(id_col)).limit(limit) if limit else out


def norm(v: Column) -> Column:
    return F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two vectors; null if they differ in length or one is zero."""
    dot = F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)
    return F.when(F.size(a) == F.size(b), F.try_divide(dot, norm(a) * norm(b)))


def vector_search(df: DataFrame, id_col: str, vector: str, query: list[float], limit: int = 10, where: Column | None = None) -> DataFrame:
    """The nearest vectors by exact cosine: id and score."""
    if where is not None:
        df = df.filter(where)
    q = F.array(*(F.lit(float(x)) for x in query))
    return df.select(id_col, cosine(F.col(vector), q).alias("score")).filter("score IS NOT NULL").orderBy(F.desc("score"), F.asc(id_col)).limit(limit)


def similar_to(df: DataFrame, id_col: str, vector: str, of: object, limit: int = 10) -> DataFrame:
    """The nearest vectors to a row's own, without that row."""
    own = df.filter(F.col(id_col) == of).select(F.col(vector).alias("__q")).limit(1)
    others = df.filter(F.col(id_col) != of).crossJoin(F.broadcast(own))  # a single row
    return others.select(id_col, cosine(F.col(vector), F.col("__q")).alias("score")).filter("score IS NOT NULL").orderBy(F.desc("score"), F.asc(id_col)).limit(limit)


def fused(rankings: list[DataFrame], id_col: str, limit: int = 10, k: int = RRF_K, depth: int = 1000) -> DataFrame:
    """Reciprocal-rank fusion of rankings (id and score), each by its `depth` best."""
    ranked = None
    for r in rankings:
        best = r.orderBy(F.desc("score"), F.asc(id_col)).limit(depth)  # so one window over it is bounded
        part = best.select(id_col, (F.lit(1.0) / (k + F.row_number().over(Window.orderBy(F.desc("score"), F.asc(id_col))))).alias("part"))
        ranked = part if ranked is None else ranked.union(part)
    return ranked.groupBy(id_col).agg(F.sum("part").alias("score"), F.count("*").alias("found_by")).orderBy(F.desc("score"), F.asc(id_col)).limit(limit)


def overlap(a: DataFrame, b: DataFrame, id_col: str) -> DataFrame:
    """Which of two result sets each id is in: both, first or second."""
    x, y = a.select(id_col).distinct().withColumn("__a", F.lit(True)), b.select(id_col).distinct().withColumn("__b", F.lit(True))
    kind = F.when(F.col("__a") & F.col("__b"), "both").when(F.col("__a"), "first").otherwise("second")
    return x.join(y, id_col, "full").select(id_col, kind.alias("found_in"))


def embedded(df: DataFrame, id_col: str, text: Column, model, dimension: int) -> DataFrame:
    """L2-normalised embeddings by a model (a picklable function from a list of texts to rows of numbers)."""
    import pandas as pd

    def run(frames):
        import numpy as np

        for f in frames:
            v = np.asarray(model(f["__text"].tolist()), float).reshape(len(f), dimension)
            size = np.linalg.norm(v, axis=1, keepdims=True)
            yield pd.DataFrame({id_col: f[id_col], "embedding": list((v / np.where(size == 0, 1, size)).astype("float32"))})

    rows = df.select(id_col, text.alias("__text")).filter("__text <> ''")
    return rows.mapInPandas(run, f"{id_col} {rows.schema[0].dataType.simpleString()}, embedding array<float>")
