"""Compare registered queries with their SQL in DuckDB: ``python tests/parity.py [folder] [name ...]``."""

from __future__ import annotations

import datetime
import decimal
import math
import os
import sys
import time
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from entityloom.catalog import CATALOG  # noqa: E402
from entityloom.sources.tables import TABLE_SCHEMAS  # noqa: E402


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLE_SCHEMAS:
        con.execute(f"create view {name} as select * from read_parquet('{folder}/{name}.parquet')")
    return con


def plain(v):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.12g}")
    if isinstance(v, datetime.datetime):
        return v.isoformat()
    if isinstance(v, bytearray):
        return bytes(v)
    return v


def kind(v):
    if isinstance(v, bool):
        return "bool"
    if isinstance(v, int):
        return "int"
    return type(v).__name__


def compare(spark, con, name: str, folder: str) -> str:
    """Empty when both results agree, else what differs."""
    entry = CATALOG[name]
    got = entry.run(spark, folder)
    columns = sorted(got.columns)
    mine = [tuple(plain(r[c]) for c in columns) for r in got.collect()]
    if entry.sql is None:
        return "" if mine else "no rows"
    cur = con.execute(entry.sql)
    names = [d[0] for d in cur.description]
    if sorted(names) != columns:
        return f"columns {columns} vs {sorted(names)}"
    order = [names.index(c) for c in columns]
    theirs = [tuple(plain(r[i]) for i in order) for r in cur.fetchall()]
    a, b = Counter(mine), Counter(theirs)
    if a != b:
        return f"{len(mine)} vs {len(theirs)} rows; only here {list((a - b).items())[:3]}; only SQL {list((b - a).items())[:3]}"
    if not mine:
        return "both empty"
    for i, c in enumerate(columns):
        kinds = [{kind(r[i]) for r in rows if r[i] is not None} for rows in (mine, theirs)]
        if kinds[0] != kinds[1]:
            return f"column {c}: {kinds[0]} vs {kinds[1]}"
    return ""


if __name__ == "__main__":
    from entityloom.session import local_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(CATALOG)
    spark, con = local_session(8), connect(folder)
    spark.sparkContext.setLogLevel("ERROR")
    bad = 0
    for n in names:
        t0 = time.time()
        try:
            verdict = compare(spark, con, n, folder)
        except Exception as e:  # noqa: BLE001
            verdict = f"{type(e).__name__}: {str(e)[:600]}"
        bad += bool(verdict)
        print(f"{'ok  ' if not verdict else 'FAIL'} {n} {time.time() - t0:.1f}s {verdict[:1500]}", flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")
