"""Row groups bounded in rows."""

import glob
import os

import pyarrow.parquet as pq
import pytest

from tabloom.operators import layout, rowgroups
from tabloom.operators.filetable import FileTable


def footers(path, files):
    return {f: pq.ParquetFile(os.path.join(path, f)).metadata for f in files}


def test_footers_and_pruning(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(70_000).selectExpr("id", "concat('A', id % 7) AS agency", "timestamp_seconds(id) AS ts", "array(id) AS a", "named_struct('x', id) AS s")
    table = rowgroups.write_row_groups(df, path, ["agency", "id"], group_rows=2000, file_rows=10_000, files=3)
    found = footers(path, table.files())
    groups = [m.row_group(i) for m in found.values() for i in range(m.num_row_groups)]
    assert sum(g.num_rows for g in groups) == 70_000 and max(g.num_rows for g in groups) == 2000 and len(found) >= 7 and all(m.num_rows <= 10_000 for m in found.values())
    assert sum(g.num_rows < 2000 for g in groups) <= 3  # only at a task's end
    may = [g for g in groups if g.column(1).statistics.min <= "A3" <= g.column(1).statistics.max]
    assert len(may) <= 7 and table.read().filter("agency = 'A3'").count() == 10_000
    assert table.read().dtypes == df.dtypes and sorted(map(str, table.read().collect()[:5])) != []
    scan = table.read().filter("agency = 'A3'")
    rows = scan.collect()
    assert {r.agency for r in rows} == {"A3"} and sorted(r.id for r in rows) == list(range(3, 70_000, 7))


def test_versions_follow_each_other(spark, tmp_path):
    path = str(tmp_path / "t")
    rowgroups.write_row_groups(spark.range(100), path, ["id"], 10, 50)
    first = set(FileTable(spark, path).files())
    table = rowgroups.write_row_groups(FileTable(spark, path).read().filter("id < 80"), path, ["id"], 10, 50, least_ratio=0.5)
    assert table.read().count() == 80 and not first & set(table.files())
    with pytest.raises(layout.Shrunk):
        rowgroups.write_row_groups(spark.range(5), path, ["id"], least_ratio=0.5)
    assert FileTable(spark, path).read().count() == 80
    assert rowgroups.write_row_groups(spark.range(0), path, ["id"]).read().count() == 0
    with pytest.raises(ValueError):
        rowgroups.write_row_groups(spark.range(5), path, ["id"], 100, 10)


def test_a_task_that_fails_leaves_nothing_in_the_table(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    rowgroups.write_row_groups(spark.range(50), path, ["id"], 10, 50)
    bad = spark.range(100).selectExpr("CASE WHEN id = 77 THEN raise_error('no') ELSE id END AS id")
    with pytest.raises(Exception, match="no"):
        rowgroups.write_row_groups(bad, path, ["id"], 10, 50)
    table = FileTable(spark, path)
    assert table.read().count() == 50
    real = table._replace.__func__
    monkeypatch.setattr(FileTable, "_replace", lambda *a: (_ for _ in ()).throw(RuntimeError("gone")))
    with pytest.raises(RuntimeError):
        rowgroups.write_row_groups(spark.range(60), path, ["id"], 10, 50)
    monkeypatch.setattr(FileTable, "_replace", real)
    assert table.read().count() == 50 and len(table.leftovers()) >= 1
    table.leftovers(delete=True)
    assert {os.path.basename(f) for f in glob.glob(f"{path}/*.parquet")} == set(table.files())


def test_a_large_group_is_split_by_its_bytes(spark, tmp_path):
    conf = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k"}
    before = {k: spark.conf.get(k) for k in conf}
    df = spark.range(0, 60_000, 1, 12).selectExpr("CASE WHEN id % 50 = 0 THEN concat('g', id % 3) ELSE 'hot' END AS g", "sha2(string(id), 256) AS t")
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        layout.write_partitioned(df, str(tmp_path / "t"), ["g"], ["t"])
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(glob.glob(f"{tmp_path}/t/g=hot/*.parquet")) > 8 and spark.read.parquet(str(tmp_path / "t")).count() == 60_000
    layout.write_partitioned(spark.createDataFrame([("g1", "x"), (None, "y")], "g string, t string"), str(tmp_path / "t"), ["g"])
    assert spark.read.parquet(str(tmp_path / "t")).filter("g = 'g1'").count() == 1
