"""Parquet files whose row groups are bounded in rows, which Spark's own writer can't do.

Spark clusters the rows; each task then writes its ranges with Arrow. A task's file
has a name of its own and counts only once the task has succeeded and its name stands in
the table's list of files, so tasks that fail, are tried again or run twice leave nothing
in the table.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.session import materialise, ship

from .filetable import FileTable
from .layout import _fs, clustered, exists, guard

GROUP_ROWS, FILE_ROWS = 20_000, 5_000_000


def _written(df: DataFrame, base: str, group_rows: int, file_rows: int) -> DataFrame:
    """Write the partitions of df below base; a row for each file: file, rows, groups."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.parquet as pq
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(base)
        writer, name, held, n, done = None, "", [], 0, []

        def close() -> None:
            nonlocal writer, n
            if writer:
                writer.close()
                done.append((name, n, -(-n // group_rows)))
            writer, n = None, 0

        def put(table: pa.Table) -> None:
            nonlocal writer, name, n
            if writer is None:
                name = f"part-{uuid.uuid4().hex}.zstd.parquet"
                writer = pq.ParquetWriter(f"{root}/{name}", table.schema, filesystem=store, compression="zstd")
            writer.write_table(table, row_group_size=group_rows)
            n += table.num_rows
            if n >= file_rows:
                close()

        for b in batches:
            held.append(b)
            while (rows := sum(x.num_rows for x in held)) >= group_rows:  # whole groups, so that one is short at a file's end only
                table = pa.Table.from_batches(held)
                take = min(rows // group_rows * group_rows, max(group_rows, file_rows - n) // group_rows * group_rows)
                put(table.slice(0, take))
                held = table.slice(take).to_batches()
        if sum(x.num_rows for x in held):
            put(pa.Table.from_batches(held))
        close()
        cols = list(zip(*done)) if done else [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64())], ["file", "rows", "groups"])

    return df.mapInArrow(run, "file string, rows long, groups long")


def write_row_groups(df: DataFrame, path: str, by: list, group_rows: int = GROUP_ROWS, file_rows: int = FILE_ROWS, files: int | None = None, least_ratio: float = 0.0) -> FileTable:
    """Make df, clustered by columns, the next version of the table at path: row groups of at most
    group_rows rows, files of about file_rows. An empty df keeps no row, and one empty file.

    Readers of the version before go on with its files until the next write; a table that
    would shrink below least_ratio of its rows is refused.
    """
    if not 0 < group_rows <= file_rows:
        raise ValueError("a file has one row group at least")
    spark = df.sparkSession
    ship(spark)
    fs, p, _ = _fs(spark, path)
    fs.mkdirs(p)
    table = FileTable(spark, path)
    old = table.files() if exists(spark, f"{path.rstrip('/')}/_files") or table._found(table.path) else []
    written = materialise(_written(clustered(df, by, files), table.path, group_rows, file_rows), "row_groups")  # once: reading it again writes nothing
    rows = written.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
    guard(rows, table.read(old).count() if old and least_ratio else None, least_ratio)
    names = [r.file for r in written.select("file").collect()]  # one for each file
    if not names:
        empty = f"{table.path}/_empty-{uuid.uuid4().hex}"
        df.limit(0).coalesce(1).write.parquet(empty)
        names = [f"part-{uuid.uuid4().hex}.parquet"]
        from .layout import moved

        _, _, Path = _fs(spark, empty)
        moved(fs, Path(f"{empty}/{table._found(empty)[0]}"), Path(f"{table.path}/{names[0]}"))
        fs.delete(Path(empty), True)
    table.adopt()
    table._replace(table.state()["files"] if not old else old, names)
    table.clean()
    return table
