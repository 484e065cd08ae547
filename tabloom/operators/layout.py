"""How tables are written: clustered, partitioned, staged and swapped."""

from __future__ import annotations

import gzip
import json
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


#: Up to so many partitions are named in a scan's predicates.
MOST_PREDICATES = 200


class Shrunk(ValueError):
    """A table would lose more rows than its guard allows."""


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm.org.apache.hadoop.fs.Path


def moved(fs, a, b) -> None:
    """Rename a to b; an error if that can't be done, which file systems report by False."""
    if not fs.rename(a, b):
        raise OSError(f"{a.toString()} couldn't be renamed to {b.toString()}")


def exists(spark: SparkSession, path: str) -> bool:
    fs, p, _ = _fs(spark, path)
    return fs.exists(p)


def clustered(df: DataFrame, by: list, files: int | None = None) -> DataFrame:
    """Rows in ranges of the given columns, sorted within, so that readers prune row groups."""
    spread = df.repartitionByRange(files, *by) if files else df.repartitionByRange(*by)
    return spread.sortWithinPartitions(*by)


def write_clustered(df: DataFrame, path: str, by: list, rows_per_file: int = 5_000_000, row_group_bytes: int = 32 << 20) -> None:
    """Row groups are bounded by bytes, files by rows; zstd."""
    clustered(df, by).write.mode("overwrite").option("compression", "zstd").option("maxRecordsPerFile", rows_per_file).option("parquet.block.size", row_group_bytes).parquet(path)


def write_partitioned(df: DataFrame, path: str, by: list[str], sort: list | None = None) -> None:
    """Overwrite only the partitions that df has; rows without a partition value go.

    A partition is spread over as many tasks as its bytes need: adaptive execution splits
    large ones and puts small ones together.
    """
    df = df.filter(" AND ".join(f"`{c}` IS NOT NULL" for c in by))
    dealt = df.hint("rebalance", *by).sortWithinPartitions(*by, *(sort or []))
    dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy(*by).parquet(path)


def guard(new_rows: int, old_rows: int | None, least_ratio: float = 0.5, least_rows: int = 0) -> None:
    """Refuse a table that has shrunk below a share of the old one, or below a floor."""
    if new_rows < least_rows:
        raise Shrunk(f"{new_rows} rows are fewer than the floor of {least_rows}")
    if old_rows and new_rows < least_ratio * old_rows:
        raise Shrunk(f"{new_rows} rows are fewer than {least_ratio:g} of the {old_rows} before")


def swap(df: DataFrame, path: str, by: list | None = None, least_ratio: float = 0.0, least_rows: int = 0) -> int:
    """Replace a table: write beside it, compare counts, then rename; returns the rows.

    A run that was broken off between its two renames is taken up by resume().
    """
    spark = df.sparkSession
    resume(spark, path)
    staged = f"{path.rstrip('/')}.__staged-{uuid.uuid4().hex}"
    old_rows = spark.read.parquet(path).count() if exists(spark, path) else None
    (clustered(df, by) if by else df).write.option("compression", "zstd").parquet(staged)
    rows = spark.read.parquet(staged).count()
    fs, live, Path = _fs(spark, path)
    try:
        guard(rows, old_rows, least_ratio, least_rows)
    except Shrunk:
        fs.delete(Path(staged), True)
        raise
    ready, gone = f"{path.rstrip('/')}.__ready", f"{path.rstrip('/')}.__old"
    fs.delete(Path(ready), True)
    moved(fs, Path(staged), Path(ready))
    if old_rows is not None:
        fs.delete(Path(gone), True)
        moved(fs, live, Path(gone))
    moved(fs, Path(ready), live)
    fs.delete(Path(gone), True)
    return rows


def resume(spark: SparkSession, path: str) -> bool:
    """Finish a swap that stopped when the old table was away: True if there was one."""
    fs, live, Path = _fs(spark, path)
    base = path.rstrip("/")
    for beside in (f"{base}.__ready", f"{base}.__old"):
        if not fs.exists(live) and fs.exists(Path(beside)):
            moved(fs, Path(beside), live)
            return True
    return False


def create_if_missing(spark: SparkSession, path: str, columns: list[str]) -> None:
    """An empty table of text columns, unless there is one."""
    if not exists(spark, path):
        spark.createDataFrame([], ", ".join(f"`{c}` string" for c in columns)).write.parquet(path)


def write_json_lines(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("compression", "gzip").option("ignoreNullFields", "false").json(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", "true").option("escape", '"').csv(path)


def envelope(df: DataFrame, version: int = 1, key: str = "docs", most: int = 1_000_000) -> bytes:
    """A gzipped JSON document of a small table: version, count, rows (nulls left out).

    It is one file by its nature, so a table of more rows than `most` is refused.
    """
    rows = df.limit(most + 1).toJSON().collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} rows don't go into one document")
    doc = {"version": version, "count": len(rows), key: [json.loads(r) for r in rows]}
    return gzip.compress(json.dumps(doc, ensure_ascii=False, separators=(",", ":")).encode(), 9, mtime=0)


def describe_markdown(df: DataFrame, title: str, notes: dict[str, str] | None = None) -> str:
    """A page about a table: its columns, types and what is known of them."""
    notes = notes or {}
    lines = [f"# {title}", "", "| column | type | description |", "|-|-|-|"]
    return "\n".join(lines + [f"| {f.name} | {f.dataType.simpleString()} | {notes.get(f.name, '')} |" for f in df.schema]) + "\n"


def write_staging(records: DataFrame, base: str, kind: str, group: str) -> int:
    """Append a run's records below base/kind, by group; nothing is written for no rows."""
    rows = records.count()
    if rows:
        write_partitioned_append(records, f"{base.rstrip('/')}/{kind}", [group])
    return rows


def write_partitioned_append(df: DataFrame, path: str, by: list[str]) -> None:
    """Append by group; a large group is spread over as many tasks as its bytes need."""
    df.hint("rebalance", *by).write.mode("append").option("compression", "zstd").partitionBy(*by).parquet(path)


def merge_partitions(staged: DataFrame, path: str, by: list[str], keys: list[str], version: str, sort: list | None = None) -> list[dict]:
    """Merge staged rows into a partitioned table, newest version of each key, touching only
    the partitions that staged rows fall into; returns those, with their rows.

    Old rows of those partitions are pruned to at the scan: by predicates if they are few, else by a
    semi join on the partition columns. The merged rows are written
    beside the table first, as a table isn't overwritten while it is read.
    """
    from tabloom.session import materialise

    from .merge import merge_latest

    spark = staged.sparkSession
    staged = staged.filter(" AND ".join(f"`{c}` IS NOT NULL" for c in by))
    touched = materialise(staged.select(*by).distinct(), "touched")
    changed = touched.limit(MOST_PREDICATES + 1).collect()
    if not changed:
        return []
    old = None
    if exists(spark, path):
        old = spark.read.parquet(path)
        if len(changed) <= MOST_PREDICATES:
            old = old.filter(reduce(lambda a, b: a | b, (reduce(lambda a, b: a & b, (F.col(c) == row[c] for c in by)) for row in changed)))
        else:
            old = old.join(touched, by, "left_semi")
        old = old.select(*(F.col(f.name).cast(staged.schema[f.name].dataType) if f.name in staged.columns else F.col(f.name) for f in old.schema))
    merged = materialise(merge_latest(old, staged, [*by, *keys], version), "merged")
    write_partitioned(merged, path, by, sort)
    return [r.asDict() for r in merged.groupBy(*by).agg(F.count("*").alias("row_count")).collect()]


def seed_partitions(spark: SparkSession, source: str, path: str, columns: list[str], by: str, ledger: str, groups: list | None = None) -> list:
    """Load a published tree into a partitioned table, one group after the other, each
    replacing what the table has of it; returns the groups loaded now.

    Groups that are done stand in a ledger, so a run that was broken off goes on where it
    stopped and no group is doubled. Columns that older files lack are null; all are text.
    A source that is a tree of the groups' folders is read folder by folder; any other is
    dealt to such a tree once, so that no group costs a scan of everything.
    """
    from tabloom.session import delete, shared_dir

    from .state import load, record

    reader = lambda: spark.read.option("mergeSchema", True)
    fs, p, _ = _fs(spark, source)
    tree, staged = any(f.getPath().getName().startswith(f"{by}=") for f in fs.listStatus(p)), None
    if not tree:
        whole = reader().option("recursiveFileLookup", True).parquet(source)
        done = load(spark, ledger).select(F.col("key").alias("__done"))
        staged = f"{shared_dir(spark)}/seed-{uuid.uuid4().hex}"
        whole.join(done, F.col(by).cast("string") == F.col("__done"), "left_anti").filter(F.col(by).isNotNull()).write.partitionBy(by).parquet(staged)
    old = reader().parquet(staged or source)
    rows = old.select(*((F.col(c) if c in old.columns else F.lit(None)).cast("string").alias(c) for c in columns))
    if groups is None:
        groups = [r[0] for r in rows.select(by).filter(F.col(by).isNotNull()).distinct().orderBy(by).collect()]  # as many as there are groups
    done = {r.key for r in load(spark, ledger).collect()}
    loaded = [g for g in groups if str(g) not in done]
    for g in loaded:
        write_partitioned(rows.filter(F.col(by) == g), path, [by])
        record(spark.createDataFrame([(str(g),)], "key string"), ledger)
    if staged:
        delete(spark, staged)
    return loaded


def merge_and_index(staged: DataFrame, path: str, index_path: str, by: list[str], keys: list[str], version: str, sort: list | None = None) -> list[dict]:
    """Merge staged rows into their partitions and replace those partitions' rows of the index."""
    from .merge import replace_partitions

    spark = staged.sparkSession
    counts = merge_partitions(staged, path, by, keys, version, sort)
    if counts:
        types = {f.name: f.dataType.simpleString() for f in staged.schema}
        fresh = spark.createDataFrame([tuple(r[c] for c in [*by, "row_count"]) for r in counts], ", ".join([*(f"`{c}` {types[c]}" for c in by), "row_count long"]))
        swap(replace_partitions(spark.read.parquet(index_path), fresh, by) if exists(spark, index_path) else fresh, index_path, by)
    return counts


def dedupe_table(spark: SparkSession, path: str, key: str, version: str, by: list | None = None, apply: bool = False) -> dict:
    """How many rows of a table repeat a key; with apply, the table of the newest rows is
    swapped in, unless it would lose more than those rows, and counted again."""
    from .merge import latest

    table = spark.read.parquet(path)
    count = lambda t: t.agg(F.count("*"), F.countDistinct(key), F.count_if(F.col(key).isNull())).first()
    rows, keys, none = count(table)
    out = {"rows": rows, "keys": keys, "excess": rows - none - keys, "applied": False}
    if apply and out["excess"]:
        kept = latest(table.filter(F.col(key).isNotNull()), [key], version).unionByName(table.filter(F.col(key).isNull()))
        swap(kept, path, by, least_rows=keys + none)
        rows, keys, none = count(spark.read.parquet(path))
        if rows - none != keys:
            raise ValueError(f"{path} still repeats keys: {rows - none} rows, {keys} keys")
        out |= {"rows_after": rows, "applied": True}
    return out


def export_snapshot(df: DataFrame, path: str, by: list, tree: str | None = None, tree_by: list[str] | None = None, least_rows: int = 0, least_ratio: float = 0.5) -> int:
    """Publish a table: clustered and swapped in behind its guards, then as a tree of partitions."""
    rows = swap(df, path, by, least_ratio, least_rows)
    if tree:
        write_partitioned(df.sparkSession.read.parquet(path), tree, tree_by or [], by)
    return rows
