"""Micro-batch ingestion: files arrive, batches are merged into a keyed table.

The table is log-structured. A batch is written as one delta, as large as the batch, and
never changed; reading merges the base, which is dealt into buckets by key, with the
deltas. Once there are many deltas they become one, and once they weigh as much as a
share of the base they are merged into the buckets that they touch, so what is written
over time stays a multiple of what arrives.

A log file for each version says which folders the table consists of, and which batch
of which stream came last. It appears whole by one rename that fails if that version
exists already, and none is ever changed. So the table is, at every moment, what the
highest log file says: a crash between any two steps leaves the table as it was, a
batch that is replayed does nothing or does its work again, and of two writers at once
one goes on top of the other. Batches are known by their stream as well as their number,
so a new checkpoint, a full refresh or a second stream starts anew.
"""

from __future__ import annotations

import json
import time
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tabloom.operators.filetable import Conflict, Log
from tabloom.operators.layout import _fs, write_partitioned
from tabloom.operators.merge import latest, union_by_name

BUCKETS = 64
#: So many deltas become one; deltas of this share of the base's bytes are merged into it.
MOST_DELTAS, LARGE_SHARE = 16, 0.5
NOTHING = {"version": -1, "base": {}, "base_bytes": 0, "deltas": [], "streams": {}}


class MergedTable:
    """A table of the newest version of each key, kept by micro-batches.

    Of equal versions the later commit wins, within a batch a hash of the row decides; a
    null version is the oldest, and a null key is a key. Columns may be added by any batch.
    """

    def __init__(self, spark: SparkSession, path: str, keys: list[str], version: str, buckets: int = BUCKETS, most_deltas: int = MOST_DELTAS, large_share: float = LARGE_SHARE):
        self.spark, self.path, self.keys, self.version, self.buckets = spark, path.rstrip("/"), keys, version, buckets
        self.most_deltas, self.large_share, self.log = most_deltas, large_share, Log(spark, f"{self.path}/_log")

    def _log(self) -> list[int]:
        return self.log.numbers()

    def _entry(self, number: int) -> dict:
        return self.log.entry(number)

    def _commit(self, entry: dict) -> None:
        self.log.commit(entry)

    def state(self) -> dict:
        """What the table consists of: base folders by bucket, deltas (folder, bytes) by age, and the last batch of each stream."""
        return self.log.last() or NOTHING

    # reading

    def _tagged(self, folders: list[tuple[str, int]]) -> DataFrame | None:
        """The rows of folders, each with its age."""
        parts = [self.spark.read.option("mergeSchema", True).parquet(f"{self.path}/{f}").withColumn("__age", F.lit(age)) for f, age in folders]
        return union_by_name(*parts) if parts else None

    def _base(self, state: dict, buckets: list[str] | None = None) -> DataFrame | None:
        folders = {b: f for b, f in state["base"].items() if buckets is None or b in buckets}
        paths = [f"{self.path}/{f}/__bucket={b}" for b, f in sorted(folders.items())]
        return self.spark.read.option("mergeSchema", True).parquet(*paths) if paths else None

    def _deltas(self, state: dict) -> DataFrame | None:
        return self._tagged([(f, i + 1) for i, (f, _) in enumerate(state["deltas"])])

    def _newest(self, base: DataFrame | None, deltas: DataFrame) -> DataFrame:
        """Base and deltas, the newest version of each key. Only base rows whose keys have a delta move."""
        bucket = lambda df: df.drop("__bucket")
        if base is None:
            return latest(bucket(deltas), self.keys, self.version, [F.col("__age").desc()]).drop("__age")
        touched = deltas.select(*(F.col(k).alias(f"__{k}") for k in self.keys)).distinct()
        same = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"__{k}")) for k in self.keys))
        both = union_by_name(base.join(touched, same, "left_semi").withColumn("__age", F.lit(0)), bucket(deltas))
        return union_by_name(base.join(touched, same, "left_anti"), latest(both, self.keys, self.version, [F.col("__age").desc()]).drop("__age"))

    def read(self) -> DataFrame | None:
        """The table as it is now; None before the first commit with rows."""
        state = self.state()
        base, deltas = self._base(state), self._deltas(state)
        return base if deltas is None else self._newest(base, deltas)

    # writing

    def _bytes(self, folder: str) -> int:
        fs, p, _ = _fs(self.spark, f"{self.path}/{folder}")
        return fs.getContentSummary(p).getLength() if fs.exists(p) else 0

    def _bucket(self):
        return F.pmod(F.xxhash64(*(F.col(k).cast("string") for k in self.keys)), F.lit(self.state().get("buckets", self.buckets))).cast("int")

    def merge(self, batch: DataFrame, number: int, stream: str = "") -> bool:
        """Commit a stream's batch; False if that stream has come further already."""
        if self.state()["streams"].get(stream, -1) >= number:
            return False
        folder = f"d-{uuid.uuid4().hex}"
        rows = latest(batch, self.keys, self.version)
        rows.write.option("compression", "zstd").parquet(f"{self.path}/{folder}")
        empty = self.spark.read.parquet(f"{self.path}/{folder}").isEmpty()
        added = [] if empty else [[folder, self._bytes(folder)]]
        while True:  # on top of whatever others commit meanwhile
            now = self.state()
            if now["streams"].get(stream, -1) >= number:
                return False
            try:
                self._commit({**now, "version": now["version"] + 1, "buckets": now.get("buckets", self.buckets), "deltas": now["deltas"] + added, "streams": now["streams"] | {stream: number}})
                break
            except Conflict:
                continue
        self._tidy()
        self._clean()
        return True

    def refresh(self, rows: DataFrame) -> None:
        """Put rows in the place of the whole table, by one commit: nothing of what was there stays."""
        folder, before = f"b-{uuid.uuid4().hex}", self.state()
        write_partitioned(latest(rows, self.keys, self.version).withColumn("__bucket", self._bucket()), f"{self.path}/{folder}", ["__bucket"])
        base = {b: folder for b in self._buckets_in(folder)}
        while True:
            now = self.state()
            late = [d for d in now["deltas"] if d not in before["deltas"]]  # batches that came while rows were written
            try:
                self._commit({**now, "version": now["version"] + 1, "buckets": now.get("buckets", self.buckets), "base": base, "base_bytes": self._bytes(folder), "deltas": late})
                break
            except Conflict:
                continue
        self._clean()

    def _buckets_in(self, folder: str) -> list[str]:
        fs, p, _ = _fs(self.spark, f"{self.path}/{folder}")
        names = [x.getPath().getName() for x in fs.listStatus(p)] if fs.exists(p) else []
        return [n.removeprefix("__bucket=") for n in names if n.startswith("__bucket=")]

    def _tidy(self) -> None:
        state = self.state()
        weight = sum(size for _, size in state["deltas"])
        if state["deltas"] and weight >= self.large_share * state["base_bytes"] and len(state["deltas"]) > 1:
            self.compact()
        elif len(state["deltas"]) >= self.most_deltas:
            self._fold(state)

    def _replaced(self, state: dict, changes) -> bool:
        """Commit changes to a state whose deltas may have grown; False if others have replaced them meanwhile."""
        old = state["deltas"]
        while True:
            now = self.state()
            if now["deltas"][: len(old)] != old or now["base"] != state["base"]:
                return False
            try:
                self._commit({**now, "version": now["version"] + 1, **changes(now["deltas"][len(old) :])})
                return True
            except Conflict:
                continue

    def _fold(self, state: dict) -> None:
        """Make one delta of all: as much is written as they weigh, less what they repeat."""
        folder = f"d-{uuid.uuid4().hex}"
        self._newest(None, self._deltas(state)).write.option("compression", "zstd").parquet(f"{self.path}/{folder}")
        self._replaced(state, lambda later: {"deltas": [[folder, self._bytes(folder)], *later]})

    def compact(self) -> bool:
        """Merge the deltas into the base's buckets that they touch; False if there was nothing
        to do, or another writer was first."""
        state = self.state()
        deltas = self._deltas(state)
        if deltas is None:
            return False
        folder, bucket = f"b-{uuid.uuid4().hex}", self._bucket()
        touched = [str(r[0]) for r in deltas.select(bucket).distinct().collect()]  # as many as there are buckets
        merged = self._newest(self._base(state, touched), deltas)
        write_partitioned(merged.withColumn("__bucket", bucket), f"{self.path}/{folder}", ["__bucket"])
        base = state["base"] | {b: folder for b in touched}
        size = sum(self._bytes(f"{f}/__bucket={b}") for b, f in base.items())
        return self._replaced(state, lambda later: {"base": base, "base_bytes": size, "deltas": later})

    # leftovers

    def _used(self, entries: list[dict]) -> set[str]:
        return {f"{f}/__bucket={b}" for e in entries for b, f in e["base"].items()} | {f for e in entries for f, _ in e["deltas"]}

    def _clean(self) -> None:
        """Delete what older log files refer to and neither the last one nor the one before it, kept for
        readers, does. Folders that no log file names may be another writer's and stay; vacuum() takes them."""
        log = self._log()
        fs, _, Path = _fs(self.spark, self.path)
        kept, gone = [self._entry(n) for n in log[-2:]], log[:-2]
        for folder in self._used([self._entry(n) for n in gone]) - self._used(kept):
            fs.delete(Path(f"{self.path}/{folder}"), True)
        for n in gone:
            fs.delete(Path(f"{self.path}/_log/{n:012d}.json"), False)

    def vacuum(self, older_than_s: float = 86_400.0) -> int:
        """Delete folders that no log file names and that are so old: what crashed runs have left."""
        fs, base, Path = _fs(self.spark, self.path)
        used = self._used([self._entry(n) for n in self._log()])
        tops, gone = {u.split("/")[0] for u in used}, 0
        for f in fs.listStatus(base):
            name = f.getPath().getName()
            if name[:2] in ("b-", "d-") and time.time() - f.getModificationTime() / 1000 >= older_than_s:
                parts = [p.getPath() for p in fs.listStatus(f.getPath()) if p.isDirectory()] if name in tops else [f.getPath()]
                for p in parts:
                    if name not in tops or name.startswith("b-") and f"{name}/{p.getName()}" not in used:
                        gone += bool(fs.delete(p, True))
        return gone


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark gives the stream of a checkpoint, which lasts as long as the checkpoint does."""
    fs, p, _ = _fs(spark, f"{checkpoint.rstrip('/')}/metadata")
    stream = fs.open(p)
    try:
        return json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))["id"]
    finally:
        stream.close()


def ingest(spark: SparkSession, source: str, schema, target: MergedTable, checkpoint: str, files_per_batch: int = 100) -> StreamingQuery:
    """Merge all Parquet files that are there, so many at a time, and stop; a later call takes up new ones.

    With another checkpoint all files are merged again: a full refresh, in which newer versions in the table still win.
    """
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source)
    put = lambda batch, number: target.merge(batch, number, stream_id(spark, checkpoint)) and None
    return stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def unique_events(stream: DataFrame, key: str, when: str, delay: str = "1 day") -> DataFrame:
    """A stream without repeats of a key within the watermark's delay."""
    return stream.withWatermark(when, delay).dropDuplicatesWithinWatermark([key])


def windowed_counts(df: DataFrame, when: str, by: list[str], size: str, slide: str | None = None, delay: str | None = None) -> DataFrame:
    """Rows in tumbling or sliding windows; the same for a batch and (with a delay) a stream."""
    if delay:
        df = df.withWatermark(when, delay)
    w = F.window(F.col(when), size, slide) if slide else F.window(F.col(when), size)
    return df.groupBy(w, *by).agg(F.count("*").alias("rows")).select(F.col("window.start").alias("start"), *by, "rows")


def sessions(df: DataFrame, when: str, by: str, gap: str) -> DataFrame:
    return df.groupBy(F.session_window(when, gap), by).agg(F.count("*").alias("rows")).select(by, F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), "rows")
