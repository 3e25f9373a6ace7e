"""Run registered queries next to their SQL in DuckDB and compare every value.

    python -m tests.oracle [--sf DIR] [name ...]
"""

from __future__ import annotations

import argparse
import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def _cell(value) -> str:
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "NULL"
    return repr(value)


def canonical(columns: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple[str, ...]]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(spark, con, name: str, fn, sql: str | None, folder: str) -> tuple[bool, str]:
    start = time.perf_counter()
    df = fn(spark, folder)
    got = canonical(df.columns, [tuple(r) for r in df.collect()])
    took = time.perf_counter() - start
    note = f"{len(got[1])} rows {took:.1f}s"
    if sql is None:
        return True, note + " (no SQL)"
    cur = con.execute(sql)
    want = canonical([d[0] for d in cur.description], cur.fetchall())
    if got[0] != want[0]:
        return False, f"{note} columns {got[0]} vs {want[0]}"
    if len(got[1]) != len(want[1]):
        extra = [r for r in got[1] if r not in set(want[1])][:2]
        missing = [r for r in want[1] if r not in set(got[1])][:2]
        return False, f"{note} vs {len(want[1])} rows\n   extra {extra}\n   missing {missing}"
    bad = [(g, w) for g, w in zip(got[1], want[1]) if g != w]
    if bad:
        return False, f"{note} {len(bad)} rows differ\n   " + "\n   ".join(f"{g}\n   {w}" for g, w in bad[:3])
    return True, note


def main() -> int:
    sys.path.insert(0, ".")
    import __spark_entry__ as entry
    from rostrum.session import build_session

    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    spark = build_session("oracle", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(args.sf)
    fns, sqls = entry.queries(), entry.oracle_sql()
    names = [n for n in fns if not args.names or any(n == a or (a.endswith("*") and n.startswith(a[:-1])) for a in args.names)]
    failed = 0
    for name in names:
        try:
            ok, note = compare(spark, con, name, fns[name], sqls.get(name), args.sf)
        except Exception as error:  # report and go on with the next query
            ok, note = False, str(error)[:1200]
        failed += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name}: {note}", flush=True)
    print(f"{len(names) - failed} of {len(names)} match")
    return 1 if failed else 0


if __name__ == "__main__":
    raise SystemExit(main())
