"""Parquet tables whose files are listed by version: updates rewrite only the files they touch.

A version's list of files is a log file that appears whole by one rename, which fails if
that version is there already. Updates write new files beside the others, commit a list
with these in place of the ones they replace, and later delete the replaced ones. Files
that an update doesn't touch keep their names and times. A tree of partitions stays one.
One name for each file comes to the driver, as with every table that Spark reads.
"""

from __future__ import annotations

import json
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.session import materialise

from .layout import _fs, moved


class Conflict(OSError):
    """Another writer has made this version."""


class Log:
    """Numbered JSON files below a folder; each appears once, whole, and is never changed."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def numbers(self) -> list[int]:
        fs, p, _ = _fs(self.spark, self.path)
        names = [f.getPath().getName() for f in fs.listStatus(p)] if fs.exists(p) else []
        return sorted(int(n.removesuffix(".json")) for n in names if n[:1].isdigit() and n.endswith(".json"))

    def entry(self, number: int) -> dict:
        fs, p, _ = _fs(self.spark, f"{self.path}/{number:012d}.json")
        stream = fs.open(p)
        try:
            return json.loads(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def last(self) -> dict | None:
        numbers = self.numbers()
        return self.entry(numbers[-1]) if numbers else None

    def commit(self, entry: dict) -> None:
        """Add entry as number entry["version"]; Conflict if there is one."""
        sc = self.spark.sparkContext
        fs, waiting, Path = _fs(self.spark, f"{self.path}/_{uuid.uuid4().hex}")
        out = fs.create(waiting, True)
        try:
            out.write(json.dumps(entry).encode())
        finally:
            out.close()
        target = Path(f"{self.path}/{entry['version']:012d}.json")
        context = sc._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), sc._jsc.hadoopConfiguration())
        try:
            context.rename(fs.makeQualified(waiting), fs.makeQualified(target), sc._gateway.new_array(sc._jvm.org.apache.hadoop.fs.Options.Rename, 0))
        except Exception as e:
            fs.delete(waiting, False)
            if fs.exists(target):
                raise Conflict(f"version {entry['version']} exists already") from e
            raise

    def drop(self, number: int) -> None:
        fs, p, _ = _fs(self.spark, f"{self.path}/{number:012d}.json")
        fs.delete(p, False)


class FileTable:
    """A table below a folder, with its lists of files in _files. `by` are its partition columns."""

    def __init__(self, spark: SparkSession, path: str, by: tuple[str, ...] = ()):
        fs, p, _ = _fs(spark, path.rstrip("/"))
        self.spark, self.by, self.path = spark, tuple(by), fs.makeQualified(p).toString()
        self.log = Log(spark, f"{self.path}/_files")

    def _found(self, path: str) -> list[str]:
        """Parquet files below a folder, relative to it."""
        fs, p, _ = _fs(self.spark, path)
        out, files = [], fs.listFiles(p, True) if fs.exists(p) else None
        while files is not None and files.hasNext():
            f = files.next().getPath().toString()
            rel = f[len(fs.makeQualified(p).toString()) + 1 :]
            if rel.endswith(".parquet") and not any(x[:1] in "_." for x in rel.split("/")):
                out.append(rel)
        return sorted(out)

    def adopt(self) -> None:
        """Make version 0 of the files that are there, unless there is a version."""
        if self.log.last() is None:
            self.log.commit({"version": 0, "files": self._found(self.path), "replaced": []})

    def files(self) -> list[str]:
        """The files of the newest version, relative to the table's folder."""
        self.adopt()
        return self.log.last()["files"]

    def read(self, files: list[str] | None = None) -> DataFrame:
        """The table, or some of its files; `_metadata` is there as with any file source."""
        names = self.files() if files is None else files
        if not names:
            raise FileNotFoundError(f"{self.path} has no file")
        return self.spark.read.option("mergeSchema", True).option("basePath", self.path).parquet(*(f"{self.path}/{f}" for f in names))

    def touched(self, changes: DataFrame, key: str, columns: list[str], files: list[str] | None = None) -> list[str]:
        """The files with a row that changes (one for each key; null: no change) would alter."""
        table = self.read(files)
        had = [c for c in columns if c in table.columns]
        old = table.select(F.col(key).alias("__key"), *(F.col(c).alias(f"__old_{c}") for c in had), F.col("_metadata.file_path").alias("__file"))
        new = changes.select(F.col(key).alias("__new"), *(F.col(c).alias(f"__new_{c}") for c in columns))
        differs = [F.col(f"__new_{c}").isNotNull() & (~F.col(f"__new_{c}").eqNullSafe(F.col(f"__old_{c}")) if c in had else F.lit(True)) for c in columns]
        hit = old.join(new, F.col("__key") == F.col("__new")).filter(reduce(lambda a, b: a | b, differs)).select("__file").distinct()
        url = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        names = [url(self.spark.sparkContext._jvm.java.net.URI(r[0])).toString() for r in hit.collect()]  # as many as files are rewritten
        base = self.path.split(":", 1)[-1].lstrip("/")
        return sorted(n.split(":", 1)[-1].lstrip("/")[len(base) + 1 :] for n in names)

    def update(self, changes: DataFrame, key: str, columns: list[str], sort: list[Column | str] = ()) -> tuple[list[str], list[str]]:
        """Set columns of the rows whose key is in changes, where changes has a value, and rewrite only
        the files in which that makes a difference; returns the files replaced and those in their place.

        changes has one row for each key (else one of them, by a hash, counts). Columns that
        the table lacks are added. Equal values, null values and unknown keys change nothing;
        rows with a null key stay. An update on top of which another writer has replaced the
        same files is refused with Conflict; others go on top of each other.
        """
        from .merge import first_of, update_where_present

        changes = materialise(first_of(changes.filter(F.col(key).isNotNull()).select(key, *columns), [key], []), "changes")
        state = self.state()
        old_files = self.touched(changes, key, columns, state["files"]) if state["files"] else []
        if not old_files:
            return [], []
        old = self.read(old_files)
        missing = [c for c in columns if c not in old.columns]
        old = old.withColumns({c: F.lit(None).cast(changes.schema[c].dataType) for c in missing})
        new = update_where_present(old.withColumn("__file", F.col("_metadata.file_path")), changes, key, columns)
        dealt = new.repartition("__file").sortWithinPartitions("__file", *sort).drop("__file")
        staged = f"{self.path}/_staged-{uuid.uuid4().hex}"
        out = dealt.write.option("compression", "zstd")
        (out.partitionBy(*self.by) if self.by else out).parquet(staged)
        fs, folder, Path = _fs(self.spark, staged)
        made = self._found(staged)
        rows, before = self.spark.read.parquet(staged).count(), old.count()
        if rows != before:
            fs.delete(folder, True)
            raise ValueError(f"{before} rows have become {rows}")
        for f in made:  # a name that no list has yet
            fs.mkdirs(Path(f"{self.path}/{f}").getParent())
            moved(fs, Path(f"{staged}/{f}"), Path(f"{self.path}/{f}"))
        fs.delete(folder, True)
        self._replace(old_files, made)
        self.clean()
        return old_files, made

    def state(self) -> dict:
        self.adopt()
        return self.log.last()

    def _replace(self, old: list[str], new: list[str]) -> None:
        while True:
            now = self.state()
            if not set(old) <= set(now["files"]):
                raise Conflict("another writer has replaced the same files")
            try:
                return self.log.commit({"version": now["version"] + 1, "files": sorted(set(now["files"]) - set(old) | set(new)), "replaced": old})
            except Conflict:
                continue

    def append(self, rows: DataFrame) -> list[str]:
        """Add rows as new files."""
        staged = f"{self.path}/_staged-{uuid.uuid4().hex}"
        out = rows.write.option("compression", "zstd")
        (out.partitionBy(*self.by) if self.by else out).parquet(staged)
        fs, folder, Path = _fs(self.spark, staged)
        self.adopt()  # before files are there that it must not take
        made = self._found(staged)
        for f in made:
            fs.mkdirs(Path(f"{self.path}/{f}").getParent())
            moved(fs, Path(f"{staged}/{f}"), Path(f"{self.path}/{f}"))
        fs.delete(folder, True)
        self._replace([], made)
        return made

    def clean(self, keep: int = 1) -> list[str]:
        """Delete the files that older versions have replaced; the last `keep` versions before the newest
        stay readable. Then a plain read of the folder gives the table again, once keep is 0."""
        numbers = self.log.numbers()
        kept = numbers[-1 - keep :]
        used = {f for n in kept for f in self.log.entry(n)["files"]}
        gone = []
        fs, _, Path = _fs(self.spark, self.path)
        for n in numbers[: -1 - keep]:
            gone += [f for f in self.log.entry(n)["files"] if f not in used]
        for f in sorted(set(gone)):
            fs.delete(Path(f"{self.path}/{f}"), False)
        for n in numbers[: -1 - keep]:
            self.log.drop(n)
        return sorted(set(gone))

    def leftovers(self, delete: bool = False) -> list[str]:
        """Files and staging folders that no version names: what broken-off updates have left. To be
        deleted only while no update runs."""
        fs, p, Path = _fs(self.spark, self.path)
        used = {f for n in self.log.numbers() for f in self.log.entry(n)["files"]}
        lost = [f for f in self._found(self.path) if f not in used]
        lost += [s.getPath().getName() for s in fs.listStatus(p) if s.getPath().getName().startswith("_staged-")]
        for f in lost if delete else ():
            fs.delete(Path(f"{self.path}/{f}"), True)
        return lost


def backfill(table: FileTable, texts: DataFrame, id_col: str, text: str = "text_content", status: str = "text_extraction_status", **choose) -> tuple[dict, list[str]]:
    """Fill texts into a table's candidates, rewriting only the files that get one; returns how many were
    selected, ok and missing, and the new files. `limit` is one budget for the whole table."""
    from .enrich import candidates, stats

    spark, df = table.spark, table.read()
    for c in (text, status):
        if c not in df.columns:
            df = df.withColumn(c, F.lit(None).cast("string"))
    wanted = materialise(candidates(df, id_col, status, **choose).select(id_col), "wanted")
    found = texts.join(wanted.select(F.col(id_col).alias("__id")), F.col("id") == F.col("__id"), "left_semi")
    changes = found.select(F.col("id").alias(id_col), F.col("text").alias(text), F.lit("ok").alias(status))
    counts = stats(wanted, texts, id_col).first().asDict()
    return counts, table.update(changes, id_col, [text, status])[1]
