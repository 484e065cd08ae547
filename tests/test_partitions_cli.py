import gzip
import json
import zipfile

from tabloom.cli import run
from tabloom.operators import layout
from tabloom.sources import readers

DDL = "agency string, year int, id string, v string, t string"


def test_merge_touches_only_changed_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    first = spark.createDataFrame([("EPA", 2024, "1", "1", "old"), ("EPA", 2023, "2", "1", "old"), ("FDA", 2024, "3", "1", "old")], DDL)
    assert len(layout.merge_partitions(first, path, ["agency", "year"], ["id"], "v")) == 3
    before = {str(p) for p in (tmp_path / "t").rglob("*.parquet")}
    more = spark.createDataFrame([("EPA", 2024, "1", "2", "new"), ("EPA", 2024, "9", None, "new"), (None, 2024, "8", "1", "x"), ("EPA", 2024, "1", "0", "stale")], DDL)
    assert layout.merge_partitions(more, path, ["agency", "year"], ["id"], "v") == [{"agency": "EPA", "year": 2024, "row_count": 2}]
    got = sorted((r.agency, r.year, r.id, r.t) for r in spark.read.parquet(path).collect())
    assert got == [("EPA", 2023, "2", "old"), ("EPA", 2024, "1", "new"), ("EPA", 2024, "9", "new"), ("FDA", 2024, "3", "old")]
    after = {str(p) for p in (tmp_path / "t").rglob("*.parquet")}
    assert {p for p in before if "agency=FDA" in p or "year=2023" in p} <= after
    assert layout.merge_partitions(more.filter("false"), path, ["agency", "year"], ["id"], "v") == []


def test_staging_and_snapshot(spark, tmp_path):
    df = spark.createDataFrame([("EPA", 2024, "1", "1", "a"), ("FDA", 2024, "2", "1", "b")], DDL)
    assert layout.write_staging(df.filter("false"), str(tmp_path), "comments", "agency") == 0 and not (tmp_path / "comments").exists()
    assert layout.write_staging(df, str(tmp_path), "comments", "agency") == 2
    assert layout.export_snapshot(spark.read.parquet(str(tmp_path / "comments")), str(tmp_path / "snap"), ["id"], str(tmp_path / "tree"), ["agency"], least_rows=2) == 2
    assert sorted(p.name for p in (tmp_path / "tree").iterdir() if p.is_dir()) == ["agency=EPA", "agency=FDA"]


def test_dumps(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"i": 1}\n\n{"i": 2}\n')
    (tmp_path / "b.json.gz").write_bytes(gzip.compress(b'[{"i": 3}, {"i": 4}]'))
    with zipfile.ZipFile(tmp_path / "c.zip", "w") as z:
        z.writestr("x.json", '{"i": 5}\r\n{"i": 6}\n')
    assert sorted(json.loads(r.value)["i"] for r in readers.dump(spark, str(tmp_path)).collect()) == [1, 2, 3, 4, 5, 6]


def test_cli(spark, tmp_path):
    spark.createDataFrame([("EPA", 2024, "1", "1", "Ozone"), ("EPA", 2024, "1", "1", "x"), ("FDA", 2024, "2", "1", "b")], DDL).write.parquet(str(tmp_path / "c.parquet"))
    go = lambda *a: run(["--base", str(tmp_path), *a], spark)
    assert go("list") == [{"name": "c", "description": ""}] and go("describe", "c")["columns"][0]["name"] == "agency"
    assert go("stats", "c", "--group", "agency") == {"rows": 3, "columns": 5, "top": [["EPA", 2], ["FDA", 1]]}
    assert go("groups", "c", "--group", "agency") == ["EPA", "FDA"] and len(go("sample", "c", "-n", "2", "--key", "id")) == 2
    assert [r["t"] for r in go("search", "c", "--columns", "t,v", "--needle", "OZONE")] == ["Ozone"]
    assert go("audit", "c", "--group", "agency", "--key", "id")[0]["excess"] == 1
    assert go("sql", "SELECT count(*) AS n FROM c")["rows"] == [[3]]
