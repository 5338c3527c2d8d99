"""Run registered queries on Spark and their SQL on DuckDB and compare the rows.

``python -m tests.oracle [--sf DIR] [--time] [name-part ...]``
"""

from __future__ import annotations

import argparse
import decimal
import math
import time

import duckdb

from tidewell.queries.entities import ENTITIES
from tidewell.queries.registry import REGISTRY, TABLES, Query, Tables, marks

ROOT = "/root/testdata"


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def norm(value):
    if value is None:
        return None
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, bool):
        return str(value)
    return str(value)


def rows(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple("\0" if r[i] is None else norm(r[i]) for i in order) for r in data)


def compare(query: Query, spark, con, sf_dir: str):
    """(number of rows, list of problems, seconds on Spark, seconds on DuckDB)."""
    start = time.time()
    df = query.run(spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    mid = time.time()
    problems = []
    sql = query.oracle()
    if sql is not None:
        cur = con.execute(sql)
        names = [d[0] for d in cur.description]
        want = cur.fetchall()
        if sorted(names) != sorted(df.columns):
            problems.append(f"columns {df.columns} against {names}")
        a, b = rows(df.columns, got), rows(names, want)
        if len(a) != len(b):
            problems.append(f"{len(a)} rows against {len(b)}")
        if a != b:
            only_a, only_b = sorted(set(a) - set(b))[:3], sorted(set(b) - set(a))[:3]
            problems.append(f"{sorted(names)}\n    spark only {only_a}\n    sql only   {only_b}")
    return len(got), problems, mid - start, time.time() - mid


def compare_entity(name: str, spark, con, sf_dir: str):
    df = getattr(Tables(spark, sf_dir), name)
    fields = [f"cast(`{c}` as string) as `{c}`" for c in df.columns]
    got = [tuple(r) for r in df.selectExpr(*fields).collect()]
    probe = Query(name, tuple((c, "s") for c in df.columns), lambda t: None, f"select * from {name}")
    cur = con.execute(probe.oracle())
    names = [d[0] for d in cur.description]
    a, b = rows(df.columns, got), rows(names, cur.fetchall())
    if a == b:
        return len(a), []
    only_a, only_b = sorted(set(a) - set(b))[:2], sorted(set(b) - set(a))[:2]
    return len(a), [f"{len(a)} against {len(b)} rows; {sorted(names)}\n  spark {only_a}\n  sql {only_b}"]


def main() -> None:
    import __spark_entry__  # noqa: F401  registers the queries
    from tidewell.session import build_session

    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default=f"{ROOT}/sf0.01")
    parser.add_argument("--entities", action="store_true")
    parser.add_argument("parts", nargs="*")
    args = parser.parse_args()
    spark = build_session("check", "local[8]", spark__ui__showConsoleProgress="false", spark__sql__shuffle__partitions="8", spark__ui__enabled="false")
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(args.sf)
    bad = 0

    def wanted(name):
        return not args.parts or any(p in name for p in args.parts)

    for name in ENTITIES if args.entities else ():
        if wanted(name):
            try:
                n, problems = compare_entity(name, spark, con, args.sf)
            except Exception as e:  # noqa: BLE001
                n, problems = 0, [str(e)[:600]]
            print(f"{'ok ' if not problems else 'BAD'} {name} rows={n}", *problems, flush=True)
            bad += bool(problems)
    for name, q in REGISTRY.items() if not args.entities else ():
        if wanted(name):
            try:
                n, problems, s, d = compare(q, spark, con, args.sf)
            except Exception as e:  # noqa: BLE001
                n, problems, s, d = 0, [type(e).__name__ + " " + str(e)[:1500]], 0, 0
            mark = "BAD" if problems else ("ok " if q.sql else "run")
            print(f"{mark} {name} rows={n} spark={s:.2f}s sql={d:.2f}s", *problems, flush=True)
            bad += bool(problems)
    print("bad:", bad)


if __name__ == "__main__":
    main()
