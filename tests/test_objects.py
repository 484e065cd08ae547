"""Listing on executors, and an outcome for each object."""

import gzip
import json
import os
from functools import partial

import pytest

from tabloom.operators import state
from tabloom.sources import objects
from tabloom.sources.records import record_types


def doc(i):
    return json.dumps({"data": {"id": i, "attributes": {"agencyId": i.split("-")[0], "title": "T"}}})


def put(root, key, content):
    path = os.path.join(root, key)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(content.encode() if isinstance(content, str) else content)


class Traced(objects.Store):
    """Remembers in a folder which prefixes were listed, and fails as its keys' names say."""

    def __init__(self, uri, trace):
        super().__init__(uri)
        self.trace = trace

    def children(self, prefix):
        open(os.path.join(self.trace, "list." + prefix.replace("/", "+")), "a").close()
        return super().children(prefix)

    def read(self, key):
        with open(os.path.join(self.trace, "read." + key.replace("/", "+")), "a") as f:
            f.write("x")
            tries = f.tell()
        if "denied" in key:
            raise PermissionError("no")
        if "forbidden" in key:
            raise OSError("AWS Error ACCESS_DENIED")
        if "gone" in key:
            raise OSError("NoSuchKey: not found")
        if "always" in key or "once" in key and tries < 2:
            raise OSError("reset by peer")
        return super().read(key)


@pytest.fixture
def store(tmp_path):
    root, trace = tmp_path / "root", tmp_path / "trace"
    root.mkdir()
    trace.mkdir()
    return str(root), str(trace), partial(Traced, f"file://{root}", str(trace))


def listed(trace):
    names = sorted(n.removeprefix("list.").replace("+", "/") for n in os.listdir(trace) if n.startswith("list."))
    for n in os.listdir(trace):
        os.remove(os.path.join(trace, n))
    return names


def test_only_new_prefixes_are_listed(spark, tmp_path, store):
    root, trace, make = store
    for k in ("EPA/EPA-2024-0001/docket/a.json", "EPA/EPA-2024-0001/comments/b.json", "EPA/EPA-2023-0002/documents/c.json", "FDA/FDA-2023-0001/documents/c.json", "FDA/FDA-2023-0001/documents/c.pdf", "FDA/FDA-2023-0009/x/d.json"):
        put(root, k, "{}")
    table, kinds = str(tmp_path / "listing"), record_types()
    out = objects.extend_listing(spark, make, table, kinds, tasks=3)
    assert sorted((r.key.split("/")[-1], r.kind, r.grp, r.year, r.length) for r in out.collect()) == [("a.json", "dockets", "EPA", 2024, 2), ("b.json", "comments", "EPA", 2024, 2), ("c.json", "documents", "EPA", 2023, 2), ("c.json", "documents", "FDA", 2023, 2)]
    assert "FDA/FDA-2023-0009" in listed(trace)
    put(root, "EPA/EPA-2024-0003/docket/e.json", "{}")
    put(root, "EPA/EPA-2024-0001/comments/late.json", "{}")
    out = objects.extend_listing(spark, make, table, kinds, tasks=3)
    assert out.count() == 5 and listed(trace) == ["", "EPA", "EPA/EPA-2024-0003", "EPA/EPA-2024-0003/docket", "FDA"]
    out = objects.extend_listing(spark, make, table, kinds, again=objects.F.col("prefix").contains("-2024-"), tasks=3)
    assert out.count() == 6 and "EPA/EPA-2024-0001" in (names := listed(trace)) and "EPA/EPA-2023-0002" not in names
    plan = out._jdf.queryExecution().toString()
    assert f"{root}/" not in plan  # the objects are in no file index
    other = objects.extend_listing(spark, make, str(tmp_path / "other"), kinds, wanted=objects.F.col("prefix").startswith("FDA/"), tasks=2)
    assert [r.grp for r in other.collect()] == ["FDA"] and "EPA/EPA-2024-0001" not in listed(trace)
    assert state.unseen(out, spark.createDataFrame([(r.key,) for r in out.limit(4).collect()], "key string")).count() == 2


def test_an_empty_store(spark, tmp_path, store):
    assert objects.extend_listing(spark, store[2], str(tmp_path / "listing"), record_types(), tasks=2).count() == 0
    assert objects.fetch(spark.createDataFrame([], "key string"), store[2], 2).count() == 0


def test_every_key_has_an_outcome(spark, tmp_path, store):
    root, trace, make = store
    contents = {
        "a/ok.json": doc("EPA-1"), "a/zip.json": gzip.compress(doc("EPA-2").encode()), "a/bom.json": "﻿" + doc("EPA-3"), "a/once.json": doc("EPA-4"), "a/always.json": doc("EPA-5"),
        "a/broken.json": "{broken", "a/list.json": "[1]", "a/empty.json": "", "a/cut.json": gzip.compress(doc("x").encode())[:-9], "a/latin.json": b'{"a": "\xe9\xff"}', "a/denied.json": "{}", "a/forbidden.json": "{}", "a/gone.json": "{}",
    }
    for k, v in contents.items():
        put(root, k, v)
    keys = spark.createDataFrame([(k,) for k in [*contents, "a/never.json", "a/ok.json", None]], "key string")
    ledger, quarantine = str(tmp_path / "ledger"), str(tmp_path / "quarantine")
    good, outcomes = objects.ingest(keys, make, record_types()["dockets"], ledger, 3)
    got = {r.key.removeprefix("a/").removesuffix(".json"): r.outcome for r in outcomes.collect()}
    assert got == {"ok": "ok", "zip": "ok", "bom": "ok", "once": "ok", "always": "transient", "broken": "parse", "list": "parse", "empty": "parse", "cut": "corrupt", "latin": "corrupt", "denied": "denied", "forbidden": "denied", "gone": "missing", "never": "missing"}
    assert sorted(r.docket_id for r in good.collect()) == ["EPA-1", "EPA-2", "EPA-3", "EPA-4"]
    tries = lambda k: os.path.getsize(os.path.join(trace, f"read.a+{k}.json"))
    assert tries("once") == 2 and tries("always") == 2 and tries("ok") == 1 and tries("broken") == 1
    again = objects.settle(outcomes, ledger, quarantine, "r1")
    assert [r.key for r in again.collect()] == ["a/always.json"]
    objects.settle(outcomes, ledger, quarantine, "r1")  # broken off and run again
    bad = spark.read.parquet(quarantine)
    assert sorted(r.key for r in bad.collect()) == sorted(f"a/{k}.json" for k, o in got.items() if o not in ("ok", "transient")) and {r.run for r in bad.collect()} == {"r1"}
    assert [r.key for r in objects.released(spark, quarantine, "corrupt").orderBy("key").collect()] == ["a/cut.json", "a/latin.json"]
    _, next_run = objects.ingest(keys, make, record_types()["dockets"], ledger, 3)
    assert [(r.key, r.outcome) for r in next_run.collect()] == [("a/always.json", "transient")]
