"""Publishing a folder of files: what has changed is copied, on the executors, and a run that broke off goes on.

A manifest is a table of a folder's files with the digests of their contents. Publishing
compares the source's manifest with the target's, copies what differs, and then puts
the new manifest in place, so a target whose manifest is there has all of its files.
"""

from __future__ import annotations

import hashlib
import posixpath
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.session import materialise, ship

from .layout import exists, swap

MANIFEST = "_manifest"
#: Bytes that a task holds of a file.
STEP = 4 << 20


def _open(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def names(spark: SparkSession, uri: str, tasks: int = 64) -> DataFrame:
    """The files below a folder (file, size), listed folder by folder on the executors; names that begin with _ or . are left out."""
    from functools import partial

    from tabloom.sources.objects import Store, _walk

    ship(spark)
    store = partial(Store, uri)
    top = materialise(_walk(spark.createDataFrame([("",)], "prefix string"), store, False), "top")
    below = _walk(top.filter("folder").select(F.col("key").alias("prefix")).repartition(tasks, "prefix"), store, True)
    files = top.filter("NOT folder").unionByName(below.filter("NOT folder")).select(F.col("key").alias("file"), F.col("length").alias("size"))
    return files.filter(~F.exists(F.split("file", "/"), lambda x: x.startswith("_") | x.startswith(".")))


def manifest(spark: SparkSession, uri: str, tasks: int = 256) -> DataFrame:
    """file, size and sha256 of every file below a folder, each read by one task in steps."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _open(uri)
        for b in batches:
            found = []
            for file in b.column(0).to_pylist():
                h = hashlib.sha256()
                with fs.open_input_stream(f"{base}/{file}") as f:
                    while data := f.read(STEP):
                        h.update(data)
                found.append(h.hexdigest())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(found, pa.string())], ["file", "size", "sha256"])

    return materialise(names(spark, uri).repartition(tasks, "file").mapInArrow(run, "file string, size long, sha256 string"), "manifest")


def _copied(files: DataFrame, source: str, target: str) -> DataFrame:
    """Copy files that the target hasn't in that content yet (file, sha256): file and what was done.
    A file takes its name when it is whole, and its content is compared on the way."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import uuid

        (src, a), (dst, b) = _open(source), _open(target)
        for batch in batches:
            done = []
            for file, want in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                place = f"{b}/{file}"
                waiting = f"{posixpath.dirname(place)}/.{uuid.uuid4().hex}"
                dst.create_dir(posixpath.dirname(place), recursive=True)
                h = hashlib.sha256()
                with src.open_input_stream(f"{a}/{file}") as f, dst.open_output_stream(waiting) as g:
                    while data := f.read(STEP):
                        h.update(data)
                        g.write(data)
                if h.hexdigest() != want:
                    dst.delete_file(waiting)
                    raise OSError(f"{file} has changed while it was published")
                dst.move(waiting, place)
                done.append("copied")
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(done, pa.string())], ["file", "done"])

    return files.select("file", "sha256").mapInArrow(run, "file string, done string")


def publish(spark: SparkSession, source: str, target: str, tasks: int = 256, delete: bool = False, least_ratio: float = 0.5) -> dict:
    """Make target have what source has; returns how many files were copied, kept and deleted.

    Only files whose content isn't at the target are copied: by the target's manifest, and
    by what a run that was broken off has left there, which is looked at again. Files that
    the source no longer has stay, unless delete; a source with less than least_ratio of
    the target's files is refused then.
    """
    own = manifest(spark, source, tasks)
    at = f"{target.rstrip('/')}/{MANIFEST}"
    known = spark.read.parquet(at) if exists(spark, at) else spark.createDataFrame([], "file string, size long, sha256 string")
    have = known.select("file", F.col("sha256").alias("had"))
    new = materialise(own.join(have, "file", "left").filter(~F.col("sha256").eqNullSafe(F.col("had"))).select("file", "sha256"), "to_copy")
    gone = materialise(known.join(own, "file", "left_anti").select("file"), "gone")
    n, lost, before, differs = own.count(), gone.count(), known.count(), not new.isEmpty()
    if delete and before and before - lost < least_ratio * before:
        raise ValueError(f"{lost} of {before} published files are no longer there")
    if exists(spark, target) and differs:  # what a run before this one copied already
        there = names(spark, target).join(new, "file", "left_semi")

        def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            fs, base = _open(target)
            for b in batches:
                found = []
                for file in b.column(0).to_pylist():
                    h = hashlib.sha256()
                    with fs.open_input_stream(f"{base}/{file}") as f:
                        while data := f.read(STEP):
                            h.update(data)
                    found.append(h.hexdigest())
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, pa.string())], ["file", "there"])

        ready = materialise(there.select("file").repartition(tasks, "file").mapInArrow(digests, "file string, there string"), "ready")
        new = new.join(ready, (new.file == ready.file) & (F.col("sha256") == F.col("there")), "left_anti")
    ship(spark)
    copied = materialise(_copied(new.repartition(tasks, "file"), source, target), "copied").count()
    kept_too = own if delete else own.unionByName(known.join(own, "file", "left_anti"))
    if differs or lost and delete or not before:
        swap(materialise(kept_too, "published"), at, ["file"])
    if delete and lost:

        def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            from pyarrow import fs as pfs

            fs, base = _open(target)
            for b in batches:
                for file in b.column(0).to_pylist():
                    if fs.get_file_info(f"{base}/{file}").type != pfs.FileType.NotFound:
                        fs.delete_file(f"{base}/{file}")
                yield b

        gone.mapInArrow(remove, "file string").count()
    return {"copied": copied, "kept": n - copied, "deleted": lost if delete else 0}
