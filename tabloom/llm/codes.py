"""Vector code compression: product codes with integer codebooks.

A vector's components become integers, the vector is cut into equal parts, and each
part is replaced by the index of the nearest entry of that part's codebook. The
codebooks are small and go to every task; an Arrow batch finds all distances of a part
at once from |x|^2 - 2 x.c + |c|^2, an exact product of int64 matrices. Each task adds
up its parts by entry, and one grouped shuffle of these sums, as long as the codebooks
whatever the input, gives the next round's entries.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_batches, materialise, table

SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6
#: Twice the square of a distance must stay below 2**63.
DISTANCE_BITS = 62


def largest(width: int) -> int:
    """The largest component for which distances of parts of that width are exact in 64 bits."""
    return int((2**DISTANCE_BITS / (4 * max(1, width))) ** 0.5)


def _kept(vectors: DataFrame, id_col: str, vec_col: str, label_col: str | None) -> DataFrame:
    """id, label and v of the rows whose vector has no null and no component that isn't finite."""
    v = F.col(vec_col).cast("array<double>")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    label = F.col(label_col) if label_col else F.lit(None).cast("int")
    return vectors.select(F.col(id_col).alias("id"), label.alias("label"), v.alias("v")).filter(F.col("v").isNotNull() & finite)


def quantised(vectors: DataFrame, parts: int = PARTS, scale: int = SCALE, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str | None = None) -> tuple[DataFrame, int]:
    """The integer vectors (id, label, q), written once, and the width of a part."""
    kept = _kept(vectors, id_col, vec_col, label_col)
    longest = kept.agg(F.max(F.size("v"))).first()[0] or 0
    width = max(1, -(-longest // parts))
    size, most = width * parts, largest(width)
    bounded_batches(vectors.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cell = b.column(2)
            at = cell.offsets.to_numpy()
            flat = cell.values.to_numpy(zero_copy_only=False)[at[0] : at[-1]]
            with np.errstate(over="ignore"):
                whole = np.clip(np.floor(flat * scale), -most, most).astype(np.int64)
            q, n = np.zeros((b.num_rows, size), np.int64), np.diff(at)
            q[np.repeat(np.arange(b.num_rows), n), np.arange(len(whole)) - np.repeat(at[:-1] - at[0], n)] = whole
            cells = pa.ListArray.from_arrays(pa.array(np.arange(0, q.size + 1, size, dtype=np.int32)), pa.array(q.ravel()))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), cells], ["id", "label", "q"])

    types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept.schema.fields[:2])
    return materialise(kept.mapInArrow(run, f"{types}, q array<bigint>"), "quantised"), width


def start(rows: DataFrame, parts: int, width: int, entries: int = ENTRIES) -> np.ndarray:
    """The parts of the vectors of the smallest ids, ascending: (parts, entries, width)."""
    first = rows.filter(F.col("id").isNotNull()).select("id").distinct().orderBy("id").limit(entries)
    of = rows.join(F.broadcast(first), "id").groupBy("id").agg(F.min("q").alias("q")).orderBy("id").collect()  # as many rows as entries
    return np.array([r.q for r in of], np.int64).reshape(len(of), parts, width).transpose(1, 0, 2)


def nearest(q: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index and squared distance of each vector's nearest entry in each part: (n, parts) both.

    The first of equally near entries is taken; all is exact in int64.
    """
    parts, _, width = books.shape
    x = q.reshape(len(q), parts, width)
    index, error = np.empty((len(q), parts), np.int64), np.empty((len(q), parts), np.int64)
    for p in range(parts):
        xp, c = np.ascontiguousarray(x[:, p]), books[p]
        far = (xp * xp).sum(axis=1)[:, None] - 2 * (xp @ c.T) + (c * c).sum(axis=1)[None]
        index[:, p] = far.argmin(axis=1)
        error[:, p] = far[np.arange(len(q)), index[:, p]]
    return index, error


def _matrix(cell: pa.Array, size: int) -> np.ndarray:
    at = cell.offsets.to_numpy()
    return cell.values.to_numpy()[at[0] : at[-1]].reshape(-1, size)


#: Vectors whose distances are held at once.
STEP = 8192


def improved(rows: DataFrame, books: np.ndarray) -> np.ndarray:
    """One round: entries become the floor of the mean of the parts nearest to them; unused ones stay."""
    parts, entries, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((parts * entries, width), np.int64), np.zeros(parts * entries, np.int64)
        for b in batches:
            every = _matrix(b.column(0), parts * width)
            for at in range(0, len(every), STEP):
                q = every[at : at + STEP]
                place = nearest(q, books)[0] + np.arange(parts) * entries
                np.add.at(total, place.ravel(), q.reshape(-1, width))
                n += np.bincount(place.ravel(), minlength=parts * entries)
        used = np.flatnonzero(n)
        place, dim = np.repeat(used, width), np.tile(np.arange(width), len(used))
        yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(dim), pa.array(total[place, dim]), pa.array(n[place])], ["place", "dim", "total", "n"])

    # as many rows as the codebooks have numbers
    sums = rows.select("q").mapInArrow(run, "place long, dim long, total long, n long").groupBy("place", "dim").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
    out = books.reshape(parts * entries, width).copy()
    for r in sums.collect():
        out[r.place, r.dim] = r.total // r.n
    return out.reshape(books.shape)


def digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def encoded(rows: DataFrame, books: np.ndarray) -> DataFrame:
    """id, label, code (two hex digits for each part) and error of every vector."""
    parts, entries, width = books.shape
    hexed = np.array([f"{k:02x}" for k in range(entries)] or [""])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            every = _matrix(b.column(2), parts * width)
            for at in range(0, len(every), STEP):
                index, error = nearest(every[at : at + STEP], books)
                code = pa.array(["".join(x) for x in hexed[index].tolist()], pa.string())
                yield pa.RecordBatch.from_arrays([b.column(0).slice(at, STEP), b.column(1).slice(at, STEP), code, pa.array(error.sum(axis=1))], ["id", "label", "code", "error"])

    types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields[:2])
    return rows.mapInArrow(run, f"{types}, code string, error long")


def compress(
    vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str | None = None
) -> tuple[DataFrame, np.ndarray]:
    """The codes of all vectors (id, label, code, error), and the codebooks (parts, entries, width).

    Rows whose vector is null or has a null or non-finite component are left out; an
    empty vector is one of zeros. Components become floor(scale * x), and those so large
    that distances would leave 64 bits are taken as the largest that doesn't (about 90,000
    before scaling, for parts of 8 components). Vectors of differing lengths are
    filled up with zeros to the longest, whose length is rounded up to whole parts.
    Codebooks start from the smallest distinct ids, as many as there are (null ids don't
    count; of an id's several vectors the least); if no row has an id, there is no entry,
    and no row is returned. Null ids and repeated rows are coded like others; an empty
    table gives no rows; other columns are ignored.
    """
    if not 0 < entries <= 256:
        raise ValueError("1 to 256 entries fit two hex digits")
    rows, width = quantised(vectors, parts, scale, id_col, vec_col, label_col)
    books = start(rows, parts, width, entries)
    if not books.size:
        return encoded(rows.filter("false"), np.zeros((parts, 1, width), np.int64)), books
    for _ in range(rounds):
        books = improved(rows, books)
    return encoded(rows, books), books


def decode(codes: DataFrame, books: np.ndarray, scale: int = SCALE, code_col: str = "code") -> DataFrame:
    """codes with `vector`, what each code stands for; null for a null code."""
    parts, entries, _ = books.shape
    book = F.array(*(F.array(*(F.array(*(F.lit(x / scale) for x in e.tolist())) for e in part)) for part in books))
    at = lambda p: F.conv(F.substring(F.col(code_col), 2 * p + 1, 2), 16, 10).cast("int")
    return codes.withColumn("vector", F.when(F.col(code_col).isNotNull(), F.flatten(F.array(*(F.get(F.get(book, F.lit(p)), at(p)) for p in range(parts))))))


def op11_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes, books = compress(table(spark, sf_dir, "embeddings"), label_col="label")
    codes = materialise(codes, "codes")  # summed by label, then joined with the sums
    by_label = codes.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "of")
    joined = codes.join(by_label, F.col("label").eqNullSafe(F.col("of")))  # a label may have a third of all rows: adaptive execution splits them
    return joined.select(F.col("id").alias("vec_id"), "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))


def op11_sql(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> str:
    """The same in DuckDB's SQL, a row for each component; for tables whose ids are distinct
    and whose vectors are of one length that parts divide."""
    least = lambda s, n: f"CAST(({s} - ((({s} % {n}) + {n}) % {n})) // {n} AS BIGINT)"
    ctes = [
        "kept AS (SELECT vec_id, label, embedding AS e FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)",
        f"x AS MATERIALIZED (SELECT vec_id, (j - 1) // (len(e) // {parts}) AS p, (j - 1) % (len(e) // {parts}) AS d, CAST(floor({scale} * CAST(e[j] AS DOUBLE)) AS BIGINT) AS v FROM (SELECT vec_id, e, unnest(range(1, len(e) + 1)) AS j FROM kept))",
        f"first AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS k FROM kept ORDER BY vec_id LIMIT {entries})",
        "b0 AS MATERIALIZED (SELECT p, k, d, v AS c FROM x JOIN first USING (vec_id))",
    ]
    for r in range(rounds + 1):
        ctes += [
            f"f{r} AS (SELECT vec_id, p, k, CAST(sum((v - c) * (v - c)) AS BIGINT) AS dist FROM x JOIN b{r} USING (p, d) GROUP BY vec_id, p, k)",
            f"a{r} AS MATERIALIZED (SELECT vec_id, p, k, dist FROM f{r} QUALIFY row_number() OVER (PARTITION BY vec_id, p ORDER BY dist, k) = 1)",
        ]
        if r < rounds:
            ctes += [
                f"m{r} AS (SELECT p, k, d, sum(v) AS s, count(*) AS n FROM x JOIN a{r} USING (vec_id, p) GROUP BY p, k, d)",
                f"b{r + 1} AS MATERIALIZED (SELECT b.p, b.k, b.d, CASE WHEN m.n IS NULL THEN b.c ELSE {least('m.s', 'm.n')} END AS c FROM b{r} b LEFT JOIN m{r} m USING (p, k, d))",
            ]
    ctes += [
        f"codes AS (SELECT vec_id, string_agg(printf('%02x', k), '' ORDER BY p) AS code, CAST(sum(dist) AS BIGINT) AS error FROM a{rounds} GROUP BY vec_id)",
        f"book AS (SELECT sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY p, k, d)) AS codebooks_sha256 FROM b{rounds})",
    ]
    return f"WITH {', '.join(ctes)} SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM codes JOIN kept USING (vec_id) CROSS JOIN book"
