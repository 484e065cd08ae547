"""Benchmark decontamination with SimHash windows, built-in functions only.

A window of a document has an item's number of words. Which windows are looked at comes
from an index of each item's rarest shingles: a window that reaches the similarity lacks
so few of the item's shingles that it has one of these. The document's shingles that
stand in such an item are anchors; a window reaches the similarity only with enough of
them, so all windows that hold so many, wherever in them these stand, are fingerprinted,
and no others.

Which items a window is near to comes from a multi-index of their 256-bit fingerprints:
each is cut into BLOCKS runs of bits. Fingerprints that differ in at most RADIUS bits
differ in at most RADIUS // BLOCKS of some run, so an item stands in the index under
all values that near to its own in each run, and a window is joined with it by run and
value: none within the radius is missed. What is found is verified by exact shingle
weights; only then are the shingles beside each other.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import let, materialise, table

SHINGLE = 5
SIMILARITY = 0.8
#: 64-bit words of a fingerprint. At a similarity of 0.8 they differ in 39 of 256 bits on average, with a deviation of
#: 5.7: one pair in a thousand of those exactly at 0.8 lies beyond the radius.
WORDS, RADIUS = 4, 56
#: Runs of bits, as (word, first bit, bits): five in each word.
RUNS = tuple((w, 13 * i, 13 if i < 4 else 12) for w in range(WORDS) for i in range(5))
BLOCKS = len(RUNS)
#: The index of rare shingles is broadcast up to so many rows (24 bytes each); a longer one is joined by a shuffle.
BROADCAST_ROWS = 2_000_000


def _words(text: Column) -> Column:
    """Runs of letters and digits, lower case."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def _shingles(w: Column, k: int) -> Column:
    """A hash of each shingle, in order; texts of fewer words are one shingle."""
    n = F.size(w)
    return F.when(n == 0, F.array().cast("array<bigint>")).when(n <= k, F.array(F.xxhash64(w))).otherwise(F.transform(F.sequence(F.lit(1), F.greatest(n - (k - 1), F.lit(1))), lambda i: F.xxhash64(F.slice(w, i, k))))


def simhash(df: DataFrame, hashes: str, most: int) -> DataFrame:
    """df with fp, the 64-bit SimHash of an array of at most `most` hashes, each as often as it stands there.

    Several bits are counted at once, in the lanes of a long, which are as wide as `most` needs.
    """
    lane = 16 if most < 1 << 16 else 32
    per = 64 // lane
    ones = sum(1 << lane * i for i in range(per))
    spread = sum(1 << (lane - 1) * i for i in range(per))  # puts bit i of a few into lane i

    def lanes(j: int) -> Column:
        few = lambda h: F.shiftrightunsigned(h, per * j).bitwiseAND((1 << per) - 1)
        return F.aggregate(hashes, F.lit(0).cast("long"), lambda a, h: a + (few(h) * F.lit(spread)).bitwiseAND(F.lit(ones)))

    counts = F.array(*(lanes(j) for j in range(64 // per)))
    one = f"shiftrightunsigned(__c[b DIV {per}], {lane} * (b % {per})) & {(1 << lane) - 1}L"
    fp = F.expr(f"aggregate(sequence(0, 63), 0L, (a, b) -> a | CASE WHEN 2 * ({one}) > size(`{hashes}`) THEN shiftleft(1L, b) ELSE 0L END)")
    # both generated, so that what names fp computes nothing again
    return df.select("*", F.inline(F.array(F.struct(counts.alias("__c"))))).select(*df.columns, F.inline(F.array(F.struct(fp.alias("fp")))))


def fingerprinted(df: DataFrame, hashes: str, most: int, seeds: int = WORDS) -> DataFrame:
    """df with fp0, fp1, ...: the words of the SimHash of an array of at most `most` hashes, each by
    hashes with a seed of its own."""
    seeded = lambda w: F.transform(hashes, lambda h: F.xxhash64(h, F.lit(w)))
    for w in range(seeds):
        if w:
            df = df.withColumn("__h", seeded(w))
        df = simhash(df, "__h" if w else hashes, most).withColumnRenamed("fp", f"fp{w}").drop("__h")
    return df


def _run_values(word: str = "fp") -> Column:
    """The value of each run of a fingerprint, with its number."""
    return F.array(*(F.struct(F.lit(k).alias("run"), F.shiftrightunsigned(f"{word}{w}", at).bitwiseAND(F.lit((1 << bits) - 1)).cast("int").alias("value")) for k, (w, at, bits) in enumerate(RUNS)))


def multi_index(items: DataFrame, radius: int) -> DataFrame:
    """items (n, item, fp0, ...) under every value that may be a near fingerprint's: n, run, value, item."""
    near = radius // BLOCKS
    masks = {bits: [m for m in range(1 << bits) if m.bit_count() <= near] for bits in {r[2] for r in RUNS}}
    wide = F.array(*(F.lit(k) for k, r in enumerate(RUNS) if r[2] == 13))
    own = items.select("n", "item", F.inline(_run_values()))
    masked = F.when(F.array_contains(wide, F.col("run")), F.lit(masks[13])).otherwise(F.lit(masks[12]))
    return own.select("n", "run", "item", F.explode(F.transform(masked, lambda m: F.col("value").bitwiseXOR(m))).alias("value"))


def _text_key(text: Column) -> list[Column]:
    """128 bits of a text: rows of one text are contaminated alike, whatever their ids."""
    return [F.xxhash64(text).alias("__k1"), F.xxhash64(F.lit("k"), text).alias("__k2")]


FP = [f"fp{w}" for w in range(WORDS)]


def _index(items: DataFrame, similarity: float) -> DataFrame:
    """The rarest shingles of each item (item, h): as many as a window may lack, and one."""
    each = items.select("item", "m", F.explode("hashes").alias("h")).groupBy("item", "m", "h").agg(F.count("*").alias("times"))
    held = each.groupBy("h").agg(F.count("*").alias("items"))
    upto = F.sum("times").over(Window.partitionBy("item").orderBy("items", "h").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    lack = F.col("m") - F.ceil(F.lit(similarity) * F.col("m") - 1e-9)
    return each.join(held, "h").withColumn("before", upto - F.col("times")).filter(F.col("before") <= lack).select("item", "h")


def _verified(docs: DataFrame, benchmark: DataFrame, radius: int, similarity: float, k: int, broadcast_rows: int) -> DataFrame:
    """Verified windows of each text: __k1, __k2 (its key), item_id, start, n_words, hamming, similarity."""
    keyed = docs.filter(F.col("text").isNotNull()).select("doc_id", "text", *_text_key(F.col("text")))
    item = benchmark.select("item_id", F.inline(let(_words(F.col("text").cast("string")), lambda w: F.array(F.struct(F.size(w).alias("n"), _shingles(w, k).alias("hashes")))))).filter("n > 0").distinct()
    item = materialise(item.select(F.xxhash64("item_id", "n", "hashes").alias("item"), "item_id", "n", F.size("hashes").alias("m"), "hashes"), "benchmark_items")
    most = item.agg(F.max("m")).first()[0] or 0
    index = materialise(_index(item, similarity), "benchmark_index")
    rows = F.broadcast(index) if index.count() <= broadcast_rows else index
    # which items each text may hold, and where their rare shingles stand
    shingled = keyed.select("__k1", "__k2", F.posexplode(let(_words(F.col("text")), lambda w: _shingles(w, k))).alias("i", "h"))
    may = shingled.join(rows, "h").groupBy("__k1", "__k2", "item").agg(F.collect_set("i").alias("rare"))  # as long as a text at most
    may = materialise(may, "benchmark_candidates")
    # those texts, each once however many rows have it, with their shingles beside each of their items
    hashed = keyed.join(may.select("__k1", "__k2").distinct(), ["__k1", "__k2"], "left_semi").groupBy("__k1", "__k2").agg(F.first("text").alias("text"))
    hashed = hashed.select("__k1", "__k2", F.inline(let(_words(F.col("text")), lambda w: F.array(F.struct(_shingles(w, k).alias("all"))))))
    prints = materialise(fingerprinted(item, "hashes", most).select("item", "item_id", "n", *FP, "hashes"), "benchmark_prints")
    lookup = materialise(multi_index(prints, radius), "benchmark_multi_index")
    hashed = materialise(hashed, "benchmark_texts")
    pairs = hashed.join(may, ["__k1", "__k2"]).join(item.select("item", "n", F.col("m").alias("item_m"), F.col("hashes").alias("item_hashes")), "item")
    # starts of windows of which `need` anchors in a row lie within; a text no longer than the item is one window
    m = f"least(size(all), greatest(n - {k - 1}, 1))"
    near = f"array_sort(array_distinct(flatten(transform(rare, i -> sequence(greatest(i - {m} + 1, 0), least(i + {m} - 1, size(all) - 1))))))"
    pairs = pairs.select("*", F.inline(F.expr(f"array(struct({m} AS m, greatest(CAST(ceil(({m} + item_m) * {similarity}D / {1 + similarity}D - 1e-9D) AS INT), 1) AS need, {near} AS near))"))).select("*", F.inline(F.expr("array(struct(filter(near, i -> array_contains(item_hashes, all[i])) AS a))")))
    low, high = "greatest(a[j + need - 1] - m + 1, 0)", "least(a[j], size(all) - m)"
    starts = f"array_distinct(flatten(transform(sequence(0, size(a) - need), j -> CASE WHEN {low} <= {high} THEN sequence({low}, {high}) ELSE array() END)))"
    windows = pairs.filter("size(a) >= need").select("__k1", "__k2", "n", F.explode(F.expr(starts)).alias("start"), "all", "m")
    windows = fingerprinted(windows.select("__k1", "__k2", "n", "start", F.expr("slice(all, start + 1, m)").alias("hashes")), "hashes", most)
    windows = materialise(windows.select("__k1", "__k2", "n", "start", *FP).distinct(), "benchmark_windows")  # shingles go no further
    met = windows.select("*", F.inline(_run_values())).join(lookup, ["n", "run", "value"]).select("__k1", "__k2", "n", "start", *FP, "item").distinct()
    theirs = prints.select("item", "item_id", F.col("hashes").alias("item_hashes"), *(F.col(c).alias(f"item_{c}") for c in FP))
    hamming = reduce(lambda a, b: a + b, (F.bit_count(F.col(c).bitwiseXOR(F.col(f"item_{c}"))) for c in FP))
    found = met.join(theirs, "item").withColumn("hamming", hamming).filter(F.col("hamming") <= radius).drop(*FP, *(f"item_{c}" for c in FP))
    near = found.join(hashed, ["__k1", "__k2"]).withColumn("hashes", F.expr(f"slice(all, start + 1, {m})"))
    once = lambda a: F.size(F.array_distinct(a)) == F.size(a)
    count = lambda side, h: F.size(F.filter(side, lambda x: x == h))
    weighed = F.aggregate(F.array_distinct("item_hashes"), F.lit(0), lambda a, h: a + F.least(count(F.col("item_hashes"), h), count(F.col("hashes"), h)))
    shared = F.when(once("hashes") | once("item_hashes"), F.size(F.array_intersect("item_hashes", "hashes"))).otherwise(weighed)
    near = near.select("__k1", "__k2", "item_id", "start", F.col("n").alias("n_words"), "hamming", F.inline(F.array(F.struct(shared.alias("shared"), (F.size("hashes") + F.size("item_hashes")).alias("both")))))
    return near.withColumn("similarity", F.col("shared") / (F.col("both") - F.col("shared"))).filter(F.col("similarity") >= similarity).drop("shared", "both")


def contaminated(docs: DataFrame, benchmark: DataFrame, radius: int = RADIUS, similarity: float = SIMILARITY, k: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text", broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Passages of docs that are near copies of benchmark items.

    Returns, for each document and item, the best window: doc_id, item_id, start (its
    first word, from 0), n_words (the item's), hamming, similarity (shared shingles over
    all, each as often as it stands in either) and windows (how many of its text were verified). Ties
    go to the first window. Words are runs of letters and digits, lower case; an item of
    fewer than k words is one shingle and matches only a whole document; null or wordless
    texts and items match nothing; rows of one id, and rows without an id, count as one
    document, by the best of their texts; equal items are all returned, and an item id may be null or stand for
    several texts; empty tables give no rows; other columns are ignored.
    """
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    best = F.max_by(F.struct("start", "n_words", "hamming", "similarity"), F.struct(F.col("similarity"), -F.col("start")))
    found = _verified(texts, benchmark, radius, similarity, k, broadcast_rows).groupBy("__k1", "__k2", "item_id").agg(best.alias("b"), F.count("*").alias("windows"))
    rows = texts.filter(F.col("text").isNotNull()).select("doc_id", *_text_key(F.col("text"))).join(materialise(found, "leaks"), ["__k1", "__k2"])
    return rows.groupBy("doc_id", "item_id").agg(F.max_by("b", F.struct(F.col("b.similarity"), -F.col("b.start"))).alias("b"), F.max_by("windows", F.struct(F.col("b.similarity"), -F.col("b.start"), "windows")).alias("windows")).select("doc_id", "item_id", "b.*", "windows")


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of docs without such a passage, with their own columns only.

    Each row goes or stays by its own text, whatever its id: ids may be null, repeated or
    missing. Rows of equal texts share their fate; a null, empty or wordless text stays;
    an empty docs gives no rows, an empty benchmark keeps all; any other column stays as
    it is, whatever its name.
    """
    texts = docs.select(F.lit(0).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    leaks = materialise(_verified(texts, benchmark, RADIUS, SIMILARITY, SHINGLE, BROADCAST_ROWS).select("__k1", "__k2").distinct(), "leaks")
    a, b = _text_key(docs[text_col].cast("string"))
    return docs.join(leaks, (a == leaks["__k1"]) & (b == leaks["__k2"]), "left_anti")


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
