"""Run named queries next to their checking SQL and compare the whole results.

As a script: ``python tests/compare.py [--sf DIR] [--slice N] [name …]``.
"""

from __future__ import annotations

import argparse
import datetime as dt
import decimal
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, decimal.Decimal):
        return ("decimal", str(value))
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return float(f"{value:.9g}") + 0.0
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, dt.date):
        return value.isoformat()
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    kinds = [columns[k] for k in order]
    data = sorted(
        (tuple(plain(row[k]) for k in order) for row in rows),
        key=lambda r: [(v is None, str(type(v)), v if v is not None else 0) for v in r],
    )
    return kinds, data


def difference(frame, con, sql: str) -> str | None:
    """None when both sides agree, else a short description."""
    mine_cols, mine = rows_of(frame.columns, frame.collect())
    cursor = con.execute(sql)
    their_cols, theirs = rows_of([d[0] for d in cursor.description], cursor.fetchall())
    if mine_cols != their_cols:
        return f"columns {mine_cols} against {their_cols}"
    if len(mine) != len(theirs):
        return f"{len(mine)} rows against {len(theirs)}"
    for a, b in zip(mine, theirs, strict=True):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return f"{dict(zip(mine_cols, a, strict=True))} against {b}"
    return None


def main() -> None:
    from roadspan.plans import catalog
    from roadspan.session import local_session

    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("--slice", default=None)
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    spark = local_session(8)
    if args.slice:
        spark.conf.set("spark.roadspan.rowsPerSlice", args.slice)
    con = connect(args.sf)
    oracles = catalog.oracle_sql()
    bad = 0
    for name, build in catalog.queries().items():
        if args.names and not any(n in name for n in args.names):
            continue
        start = time.time()
        try:
            frame = build(spark, args.sf)
            if name in oracles:
                found = difference(frame, con, oracles[name])
                status = "ok" if found is None else "DIFFERENT " + found
            else:
                status = f"rows {len(frame.collect())}"
        except Exception as error:  # report and go on with the next query
            status = f"ERROR {type(error).__name__} {str(error)[:600]}"
        bad += status.startswith(("DIFF", "ERR"))
        print(f"{name:42s} {time.time() - start:6.2f}s {status}", flush=True)
    print("failures:", bad)


if __name__ == "__main__":
    main()
