"""Run every query next to its SQL twin: ``python tests/check_queries.py [sf_dir] [name ...]``."""

from __future__ import annotations

import datetime as dt
import decimal
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402
from pagefacts.catalog.base import TABLES  # noqa: E402


def duck(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return ("dec", str(value.normalize()))
    if isinstance(value, float):
        return ("num", repr(round(value, 9)))
    if isinstance(value, dt.datetime):
        return ("ts", value.replace(tzinfo=None).isoformat())
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(_plain(r[i]) for i in order) for r in rows]
    return [names[i] for i in order], sorted(out, key=repr)


def compare(spark, con, name, sf_dir):
    """None when equal, else what differs."""
    df = entry.queries()[name](spark, sf_dir)
    got_names, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return None if got else "no rows"
    res = con.execute(sql)
    want_names, want = rows_of([d[0] for d in res.description], res.fetchall())
    if got_names != want_names:
        return f"columns {got_names} != {want_names}"
    if not want:
        return "the twin gives no rows"
    if len(got) != len(want):
        only = [r for r in got if r not in set(want)][:2], [r for r in want if r not in set(got)][:2]
        return f"{len(got)} rows != {len(want)}; {only}"
    for g, w in zip(got, want):
        if g != w:
            return f"{g}\n   != {w}"
    return None


if __name__ == "__main__":
    from pagefacts.session import local_session

    args = sys.argv[1:]
    sf = args.pop(0) if args and os.path.isdir(args[0]) else "/root/testdata/sf0.01"
    session = local_session(8)
    session.sparkContext.setLogLevel("ERROR")
    con = duck(sf)
    bad = 0
    for query in args or entry.queries():
        start = time.time()
        try:
            problem = compare(session, con, query, sf)
        except Exception as e:  # report and go on
            problem = f"{type(e).__name__}: {str(e)[:1500]}"
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {query} {time.time() - start:.1f}s", flush=True)
        if problem:
            print("   ", problem[:1800], flush=True)
    print("failed:", bad)
