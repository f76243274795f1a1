"""Run registered queries against their SQL: `python -m tests.oracle [sf_dir] [name ...]`."""

from __future__ import annotations

import math
import sys
import time

import duckdb
import pandas as pd

from __spark_entry__ import oracle_sql, queries
from tests.conftest import make_session

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def plain(value):
    if value is None or value is pd.NaT or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, bool):
        return value
    if hasattr(value, "item"):
        value = value.item()
    if isinstance(value, float):
        return float(repr(value))
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def compare(con, df, sql) -> list[str]:
    began = time.time()
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    took = time.time() - began
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    kinds = {d[0]: str(d[1]) for d in cursor.description}
    want = rows_of(names, cursor.fetchall())
    problems = []
    if sorted(df.columns) != sorted(names):
        problems.append(f"columns {sorted(df.columns)} != {sorted(names)}")
    same = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN"}
    for name, kind in df.dtypes:
        if name in kinds and same.get(kind) != kinds[name]:
            problems.append(f"type {name}: {kind} vs {kinds[name]}")
    if len(got) != len(want):
        problems.append(f"rows {len(got)} != {len(want)}")
    if got != want:
        missing, extra = set(want) - set(got), set(got) - set(want)
        problems.append(f"only SQL ({len(missing)}): {sorted(missing, key=repr)[:3]}; "
                        f"only Spark ({len(extra)}): {sorted(extra, key=repr)[:3]}")
    if not got:
        problems.append("no rows")
    print(f"     collect {took:.2f}s", end=" ")
    return problems


def main() -> int:
    args = sys.argv[1:]
    sf = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    spark, con = make_session(), connect(sf)
    oracles, bad = oracle_sql(), 0
    for name, run in queries().items():
        if args and name not in args:
            continue
        began = time.time()
        try:
            df = run(spark, sf)
            print(f"     build {time.time() - began:.2f}s", end=" ")
            if name in oracles:
                problems = compare(con, df, oracles[name])
            else:
                problems = [] if df.count() else ["no rows"]
        except Exception as e:  # report and go on
            problems = [f"{type(e).__name__}: {str(e)[:600]}"]
        bad += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {name} {time.time() - began:.2f}s "
              f"{'' if name in oracles else '(rows only) '}{'; '.join(problems)}", flush=True)
    print(f"{bad} failing")
    return bad


if __name__ == "__main__":
    sys.exit(main())
