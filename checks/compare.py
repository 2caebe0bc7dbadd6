"""Run registered queries beside their SQL and report differences.

    python -m checks.compare [--sf DIR] [--only PART] [name ...]
"""

from __future__ import annotations

import argparse
import sys
import time

import duckdb

from checks.catalog import QUERIES
from checks.oracle import SQL
from orderloom.session import local_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def canonical(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(repr(row[i]) for i in order) for row in rows)


def difference(frame, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None if the frame equals the SQL result value by value, else what differs."""
    columns = frame.columns
    ours = canonical(columns, [tuple(r) for r in frame.collect()])
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    theirs = canonical(names, cursor.fetchall())
    if sorted(columns) != sorted(names):
        return f"columns {sorted(columns)} against {sorted(names)}"
    if len(ours) != len(theirs):
        return f"{len(ours)} rows against {len(theirs)}"
    for a, b in zip(ours, theirs):
        if a != b:
            cells = [(c, x, y) for c, x, y in zip(sorted(columns), a, b) if x != y]
            return f"values {cells[:4]} in {a}"
    return None


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("--only", default="")
    parser.add_argument("--skip", nargs="*", default=[])
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    spark = local_session("8")
    con = oracle_connection(args.sf)
    failed = 0
    for name, run in QUERIES.items():
        if (args.names and name not in args.names) or args.only not in name or name in args.skip:
            continue
        started = time.time()
        try:
            frame = run(spark, args.sf)
            note = difference(frame, con, SQL[name]) if name in SQL else f"rows only: {frame.count()}"
            ok = note is None or name not in SQL
        except Exception as error:  # report every query, then fail
            ok, note = False, f"{type(error).__name__}: {str(error)[:600]}"
        failed += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name} {time.time() - started:.1f}s {note or ''}", flush=True)
    for name in sorted(set(SQL) - set(QUERIES)):
        failed += 1
        print(f"FAIL {name}: SQL without a query")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
