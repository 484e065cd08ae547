"""Updates rewrite only the files they touch."""

import os
import time

import pytest

from tabloom.operators import filetable, layout
from tabloom.operators.filetable import Conflict, FileTable

SCHEMA = "id string, agency string, v string, t string"


def files(path):
    return {os.path.relpath(os.path.join(d, f), path): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


@pytest.fixture
def tree(spark, tmp_path):
    path = str(tmp_path / "t")
    for part in range(3):
        rows = [(f"{a}{part}{i}", a, "1", None) for a in ("EPA", "FDA", "DOE x") for i in range(4)]
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").partitionBy("agency").parquet(path)
    return path, FileTable(spark, path, ("agency",))


def got(table):
    return {r.id: (r.agency, r.v, r.t) for r in table.read().collect()}


def test_untouched_files_keep_their_names_and_times(spark, tree):
    path, table = tree
    before, rows = files(path), got(table)
    time.sleep(0.02)
    changes = spark.createDataFrame([("EPA01", "2", "new"), ("DOE x11", None, "new"), ("FDA01", "1", None), ("none", "9", "9"), (None, "9", "9"), ("EPA02", None, None)], "id string, v string, t string")
    old, new = table.update(changes, "id", ["v", "t"])
    assert len(old) == 2 and len(new) == 2 and {os.path.dirname(f) for f in old} == {os.path.dirname(f) for f in new} and all("EPA" in f or "DOE" in f for f in old)
    rows |= {"EPA01": ("EPA", "2", "new"), "DOE x11": ("DOE x", "1", "new")}
    assert got(table) == rows
    after = files(path)
    assert {f: t for f, t in after.items() if f in before and f not in old} == {f: t for f, t in before.items() if f not in old} and set(after) - set(before) == set(new)
    table.clean(keep=0)
    assert files(path).keys() == set(table.files()) and {r.id: (r.agency, r.v, r.t) for r in spark.read.parquet(path).collect()} == rows
    assert table.update(changes, "id", ["v", "t"]) == ([], [])  # the same again changes nothing


def test_new_columns_and_repeated_changes(spark, tree):
    _, table = tree
    table.update(spark.createDataFrame([("EPA00", 5), ("EPA00", 5)], "id string, more int"), "id", ["more"])
    assert {r.id: r.more for r in table.read().filter("more IS NOT NULL").collect()} == {"EPA00": 5} and table.read().count() == 36
    assert table.update(spark.createDataFrame([], "id string, v string"), "id", ["v"]) == ([], [])


@pytest.mark.parametrize("step", ["moved", "_replace", "clean"])
def test_a_crash_leaves_the_table(spark, tree, monkeypatch, step):
    path, table = tree
    rows, changes = got(table), spark.createDataFrame([("EPA01", "2")], "id string, v string")

    def crash(*a, **k):
        raise RuntimeError("gone")

    with monkeypatch.context() as m:
        m.setattr(filetable if step == "moved" else table, step, crash)
        with pytest.raises(RuntimeError):
            table.update(changes, "id", ["v"])
    assert got(table) == (rows | {"EPA01": ("EPA", "2", None)} if step == "clean" else rows)
    assert bool(table.leftovers(delete=True)) == (step != "clean") and not table.leftovers()
    table.update(changes, "id", ["v"])
    assert got(table) == rows | {"EPA01": ("EPA", "2", None)}


def test_writers_go_on_top_of_each_other_or_are_refused(spark, tree, monkeypatch):
    path, table = tree
    other, real = FileTable(spark, path, ("agency",)), table._replace

    def meanwhile(key):
        def put(old, new):
            monkeypatch.setattr(table, "_replace", real)
            other.update(spark.createDataFrame([(key, "other")], "id string, t string"), "id", ["t"])
            return real(old, new)

        monkeypatch.setattr(table, "_replace", put)

    change = spark.createDataFrame([("EPA01", "mine")], "id string, t string")
    meanwhile("FDA01")
    table.update(change, "id", ["t"])
    assert {k: r[2] for k, r in got(table).items() if r[2]} == {"EPA01": "mine", "FDA01": "other"}
    meanwhile("EPA02")
    with pytest.raises(Conflict):
        table.update(spark.createDataFrame([("EPA01", "again")], "id string, t string"), "id", ["t"])
    assert {k: r[2] for k, r in got(table).items() if r[2]} == {"EPA01": "mine", "EPA02": "other", "FDA01": "other"}


def test_appended_files_and_a_table_without_partitions(spark, tmp_path):
    path = str(tmp_path / "plain")
    spark.range(10).selectExpr("id", "'a' AS v").coalesce(2).write.parquet(path)
    table = FileTable(spark, path)
    assert len(table.append(spark.range(10, 12).selectExpr("id", "'b' AS v").coalesce(1))) == 1 and table.read().count() == 12
    old, new = table.update(spark.createDataFrame([(11, "c")], "id long, v string"), "id", ["v"])
    assert len(old) == len(new) == 1 and table.read().filter("v = 'c'").count() == 1 and table.read().count() == 12


def test_backfill_returns_only_changed_files(spark, tmp_path):
    path, pdf = str(tmp_path / "c"), '[{"url": "u"}]'
    for i in range(4):
        spark.createDataFrame([(f"C{i}{k}", "EPA" if i < 2 else "FDA", pdf if k < 3 else "[]", None, None) for k in range(4)], "id string, agency string, attachments_json string, text_content string, text_extraction_status string").coalesce(1).write.mode("append").partitionBy("agency").parquet(path)
    table = FileTable(spark, path, ("agency",))
    texts = spark.createDataFrame([("C00", "text"), ("C03", "no attachments"), ("C21", "text"), ("C99", "none")], "id string, text string")
    counts, changed = filetable.backfill(table, texts, "id", limit=3)  # C00, C01, C02
    assert counts == {"selected": 3, "ok": 1, "missing": 2} and len(changed) == 1 and changed[0].startswith("agency=EPA/")
    counts, changed = filetable.backfill(table, texts, "id")
    assert counts == {"selected": 11, "ok": 1, "missing": 10} and len(changed) == 1 and changed[0].startswith("agency=FDA/")
    assert sorted((r.id, r.text_content) for r in table.read().filter("text_extraction_status = 'ok'").collect()) == [("C00", "text"), ("C21", "text")]
    assert filetable.backfill(table, texts, "id")[1] == []


def test_renames_that_fail_are_errors(spark, tmp_path):
    class Unwilling:
        def rename(self, a, b):
            return False

    _, a, Path = layout._fs(spark, str(tmp_path / "a"))
    with pytest.raises(OSError, match="couldn't be renamed"):
        layout.moved(Unwilling(), a, Path(str(tmp_path / "b")))


def test_seeding_reads_each_folder_of_a_tree_alone(spark, tmp_path, monkeypatch):
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    spark.createDataFrame([(str(i), "ABC"[i % 3]) for i in range(30)], "id string, agency string").write.partitionBy("agency").parquet(src)
    plans, real = [], layout.write_partitioned
    monkeypatch.setattr(layout, "write_partitioned", lambda df, *a: (plans.append(df._jdf.queryExecution().executedPlan().toString()), real(df, *a))[1])
    assert layout.seed_partitions(spark, src, out, ["id", "agency"], "agency", str(tmp_path / "ledger")) == ["A", "B", "C"]
    assert spark.read.parquet(out).count() == 30 and all("PartitionFilters: [isnotnull(agency" in p for p in plans) and len(plans) == 3
