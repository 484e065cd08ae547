"""python -m tabloom.cli: look at tables from a shell."""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import functions as F

from tabloom.operators import layout, merge, rollups, search
from tabloom.plans.service import Service, jsonable
from tabloom.session import get_session
from tabloom.sources import readers


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tabloom")
    p.add_argument("--base", required=True, help="folder of <table>.parquet")
    sub = p.add_subparsers(dest="command", required=True)
    sub.add_parser("list")
    for name, more in {"describe": (), "stats": ("--group",), "sample": ("-n", "--key"), "groups": ("--group",), "search": ("--columns", "--needle", "-n"), "audit": ("--group", "--key")}.items():
        c = sub.add_parser(name)
        c.add_argument("table")
        for m in more:
            c.add_argument(m, type=int if m == "-n" else str, default=10 if m == "-n" else None)
    c = sub.add_parser("dedupe")
    c.add_argument("table")
    c.add_argument("--key", required=True)
    c.add_argument("--version", required=True)
    c.add_argument("--apply", action="store_true")
    c = sub.add_parser("download")
    c.add_argument("table")
    c.add_argument("target")
    c = sub.add_parser("sql")
    c.add_argument("statement")
    c.add_argument("--max-rows", type=int, default=25)
    return p


def run(argv: list[str], spark=None) -> object:
    a = parser().parse_args(argv)
    spark = spark or get_session("tabloom-cli", "local[*]")
    if a.command in ("list", "describe", "sql"):
        from tabloom.operators.layout import _fs

        fs, base, _ = _fs(spark, a.base)
        names = sorted(n[: -len(".parquet")] for n in (f.getPath().getName() for f in fs.listStatus(base)) if n.endswith(".parquet"))
        service = Service(spark, lambda s: readers.register(s, {n: [f"{a.base}/{n}.parquet"] for n in names}))
        return service.list_sources() if a.command == "list" else service.describe_table(a.table) if a.command == "describe" else service.query_sql(a.statement, a.max_rows)
    if a.command == "dedupe":
        return layout.dedupe_table(spark, f"{a.base}/{a.table}.parquet", a.key, a.version, apply=a.apply)
    if a.command == "download":
        return readers.copy_if_there(spark, f"{a.base}/{a.table}.parquet", a.target)
    df = readers.parquet(spark, f"{a.base}/{a.table}.parquet")
    if a.command == "stats":
        top = rollups.top(df.groupBy(a.group).count(), 5, F.desc("count"), F.asc_nulls_last(a.group)).collect() if a.group else []
        return {"rows": df.count(), "columns": len(df.columns), "top": [list(map(jsonable, r)) for r in top]}
    if a.command == "groups":
        return [jsonable(r[0]) for r in df.select(a.group).filter(F.col(a.group).isNotNull()).distinct().orderBy(a.group).collect()]
    out = {
        "sample": lambda: rollups.exact_sample(df, a.n, 42, a.key or df.columns[0]),
        "search": lambda: search.keyword_search(df, a.columns.split(","), a.needle, a.n),
        "audit": lambda: merge.duplicate_audit(df, a.group, a.key),
    }[a.command]()
    return [jsonable(r) for r in out.collect()]


if __name__ == "__main__":
    json.dump(run(sys.argv[1:]), sys.stdout, indent=2, ensure_ascii=False)
    print()
