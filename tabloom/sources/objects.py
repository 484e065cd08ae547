"""Objects in a store: listed by prefixes on the executors, and read with an outcome for each.

The driver never holds object names. A store is a folder below a URI that pyarrow.fs
opens, or anything with the two methods of Store; it is made anew in each task.

Listing goes down level by level: each level's folders are a table whose rows are spread
over tasks. What is found is kept as a listing table, which later runs extend: only
prefixes that are new, or that the caller wants to see again, are listed. Reading gives
every key an outcome, with one more try of what may succeed then.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.operators.layout import exists
from tabloom.operators.state import load, record
from tabloom.session import materialise, ship

from .records import RecordType

#: How a read may end. All but transient are settled: trying again gives the same.
OK, MISSING, DENIED, TRANSIENT, PARSE, CORRUPT = "ok", "missing", "denied", "transient", "parse", "corrupt"
OUTCOMES = (OK, MISSING, DENIED, TRANSIENT, PARSE, CORRUPT)


class Store:
    """A folder of a file system. Keys and prefixes are relative to it."""

    def __init__(self, uri: str):
        from pyarrow import fs

        self.fs, self.base = fs.FileSystem.from_uri(uri)
        self.base = self.base.rstrip("/")

    def children(self, prefix: str) -> Iterator[tuple[str, bool, int, float | None]]:
        """What stands in a prefix: key, whether it is a prefix itself, bytes, and when it was changed (seconds)."""
        from pyarrow import fs

        selector = fs.FileSelector(f"{self.base}/{prefix}".rstrip("/"), allow_not_found=True)
        for f in self.fs.get_file_info(selector):
            yield f.path[len(self.base) + 1 :], f.type == fs.FileType.Directory, f.size or 0, f.mtime_ns / 1e9 if f.mtime_ns else None

    def read(self, key: str) -> bytes:
        with self.fs.open_input_stream(f"{self.base}/{key}") as f:
            return f.read()


def _walk(prefixes: DataFrame, store: Callable[[], Store], whole: bool) -> DataFrame:
    """What stands in each prefix (whole: in all below it as well): prefix, key, folder, length, changed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s, rows = store(), []

        def out() -> pa.RecordBatch:
            cols = list(zip(*rows)) if rows else [()] * 5
            kinds = (pa.string(), pa.string(), pa.bool_(), pa.int64(), pa.float64())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], ["prefix", "key", "folder", "length", "changed"])

        for b in batches:
            for prefix in b.column(0).to_pylist():
                todo = [prefix]
                while todo:
                    for key, folder, length, changed in s.children(todo.pop()):
                        if folder and whole:
                            todo.append(key)
                        else:
                            rows.append((prefix, key, folder, length, changed))
                        if len(rows) >= 10_000:
                            yield out()
                            rows.clear()
        yield out()

    return prefixes.select("prefix").mapInArrow(run, "prefix string, key string, folder boolean, length long, changed double")


def prefixes(spark: SparkSession, store: Callable[[], Store], depth: int = 2, tasks: int = 64) -> DataFrame:
    """The folders of a store so many levels down (prefix), each level listed by the tasks of the one before."""
    ship(spark)
    level = spark.createDataFrame([("",)], "prefix string")
    for _ in range(depth):
        level = materialise(_walk(level.repartition(tasks, "prefix"), store, False).filter("folder").select(F.col("key").alias("prefix")), "prefixes")
    return level


def classified(keys: DataFrame, kinds: dict[str, RecordType]) -> DataFrame:
    """Objects of known kinds with kind (the first whose path part the key has), grp (the first
    folder) and year (of a folder name like X-2024-0001)."""
    kind = F.lit(None).cast("string")
    for name, k in reversed(list(kinds.items())):
        kind = F.when(F.concat(F.lit("/"), "key").contains(k.path_part), F.lit(name)).otherwise(kind)
    out = keys.filter(F.col("key").endswith(".json")).withColumn("kind", kind).withColumn("grp", F.regexp_extract("key", r"^([^/]+)/", 1))
    return out.withColumn("year", F.regexp_extract("key", r"/[A-Za-z_]+-(\d{4})-", 1).try_cast("int")).filter("kind IS NOT NULL")


def extend_listing(spark: SparkSession, store: Callable[[], Store], path: str, kinds: dict[str, RecordType], depth: int = 2, again: Column | None = None, wanted: Column | None = None, tasks: int = 256) -> DataFrame:
    """List the store's new prefixes into the listing table at path, and return the table:
    prefix, key, length, changed, kind, grp and year.

    `wanted` says of a prefix whether it is listed at all (its agency or year, say);
    `again` which of those in the table are listed once more, as objects may have come.
    Keys that are there already aren't added twice. Prefixes are remembered even if they
    have no object of a known kind. A run that is broken off lists its prefixes again.
    """
    ship(spark)
    objects, seen = f"{path.rstrip('/')}/objects", f"{path.rstrip('/')}/prefixes"
    found = prefixes(spark, store, depth, tasks)
    if wanted is not None:
        found = found.filter(wanted)
    known = load(spark, seen)
    new = found.join(known, F.col("prefix") == F.col("key"), "left_anti")
    if again is not None:
        new = new.union(found.join(known, F.col("prefix") == F.col("key"), "left_semi").filter(again)).distinct()
    new = materialise(new, "new_prefixes")
    rows = classified(_walk(new.repartition(tasks, "prefix"), store, True).filter("NOT folder"), kinds).drop("folder")
    if exists(spark, objects):
        rows = rows.join(spark.read.parquet(objects).select(F.col("key").alias("__k")), F.col("key") == F.col("__k"), "left_anti")
    rows.write.mode("append").parquet(objects)
    record(new, seen, "prefix")
    return spark.read.schema("prefix string, key string, length long, changed double, kind string, grp string, year int").parquet(objects)


def outcome_of(e: BaseException) -> str:
    """What an error while reading means."""
    if isinstance(e, FileNotFoundError):
        return MISSING
    if isinstance(e, PermissionError) or re.search(r"access.?denied|forbidden|\b403\b", str(e), re.I):
        return DENIED
    if re.search(r"no ?such ?(key|file)|not ?found|\b404\b", str(e), re.I):
        return MISSING
    return TRANSIENT


def decoded(content: bytes) -> tuple[str | None, str]:
    """The text of an object, gzipped or plain, and how that ended: a JSON object, or parse or corrupt."""
    import gzip
    import zlib

    try:
        if content[:2] == b"\x1f\x8b":
            content = gzip.decompress(content)
        text = content.decode("utf-8-sig")
    except (OSError, EOFError, zlib.error, UnicodeDecodeError):
        return None, CORRUPT
    try:
        return text, OK if isinstance(json.loads(text), dict) else PARSE
    except ValueError:
        return text, PARSE


def _fetched(keys: DataFrame, store: Callable[[], Store]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = store()
        names = ["key", "value", "outcome", "error"]
        for b in batches:
            rows, size = [], 0
            for key in b.column(0).to_pylist():
                try:
                    text, outcome = decoded(s.read(key))
                    error = None if outcome == OK else f"{outcome}: {len(text or '')} characters"
                except Exception as e:  # every failure becomes this key's outcome
                    text, outcome, error = None, outcome_of(e), f"{type(e).__name__}: {e}"[:500]
                rows.append((key, text, outcome, error))
                size += len(text or "")
                if size > 16 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*rows)], names)
                    rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*rows)], names)

    return keys.select("key").mapInArrow(run, "key string, value string, outcome string, error string")


def fetch(keys: DataFrame, store: Callable[[], Store], tasks: int = 256) -> DataFrame:
    """Every key's object as a row: key, value (its text), outcome and error; transient failures
    are tried once more. Written once, so that what follows doesn't read the store again."""
    ship(keys.sparkSession)
    first = materialise(_fetched(keys.select("key").filter("key IS NOT NULL").distinct().repartition(tasks, "key"), store), "fetched")
    failed = first.filter(F.col("outcome") == TRANSIENT)
    second = materialise(_fetched(failed.repartition(tasks, "key"), store), "fetched_again")
    return first.filter(F.col("outcome") != TRANSIENT).unionByName(second)


def ingest(keys: DataFrame, store: Callable[[], Store], kind: RecordType, ledger: str, tasks: int = 256) -> tuple[DataFrame, DataFrame]:
    """Records of the keys that aren't in the ledger, and the outcomes of all of these.

    settle() writes the ledger once the records are safe. Nothing is lost silently: each
    key is a record's, or stands in the outcomes with what went wrong.
    """
    from tabloom.operators.state import unseen

    from .readers import json_text_records

    spark = keys.sparkSession
    got = fetch(unseen(keys.select("key"), load(spark, ledger)), store, tasks)
    good, bad = json_text_records(kind, got.filter(F.col("outcome") == OK), "value")
    outcomes = got.select("key", "outcome", "error").join(bad.select(F.col("key").alias("__k")), F.col("key") == F.col("__k"), "left")
    odd = F.col("__k").isNotNull()
    return good, outcomes.select("key", F.when(odd, F.lit(PARSE)).otherwise(F.col("outcome")).alias("outcome"), F.when(odd, F.lit("no record")).otherwise(F.col("error")).alias("error"))


def settle(outcomes: DataFrame, ledger: str, quarantine: str, run: str) -> DataFrame:
    """Put what failed for good into the quarantine table, then all settled keys into the ledger;
    returns the transient ones, which the next run takes up as they are in neither."""
    outcomes = materialise(outcomes, "outcomes")
    spark, bad = outcomes.sparkSession, outcomes.filter(~F.col("outcome").isin(OK, TRANSIENT)).withColumn("run", F.lit(run))
    if exists(spark, quarantine):  # a run that was broken off between the two doesn't put a key there twice
        bad = bad.join(spark.read.parquet(quarantine).select(F.col("key").alias("__k")), F.col("key") == F.col("__k"), "left_anti")
    bad.write.mode("append").parquet(quarantine)
    record(outcomes.filter(F.col("outcome") != TRANSIENT), ledger)
    return outcomes.filter(F.col("outcome") == TRANSIENT)


def released(spark: SparkSession, quarantine: str, *outcomes: str) -> DataFrame:
    """Keys of the quarantine table to be read again after a fix: fetch() takes them as they are."""
    rows = spark.read.parquet(quarantine)
    return rows.filter(F.col("outcome").isin(*outcomes)) if outcomes else rows
