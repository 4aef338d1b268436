"""Compare registered queries with their SQL twins: row count, column names, types and values."""

from __future__ import annotations

import datetime
import decimal
import sys
import time

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def plain(v):
    if isinstance(v, float):
        return None if v != v else float(f"{v:.9g}")
    if isinstance(v, decimal.Decimal):
        return float(v) if v % 1 else int(v)
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return v


def family_of(v):
    if isinstance(v, bool):
        return "bool"
    return type(v).__name__


def rows_of(names, records):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), [tuple(plain(r[i]) for i in order) for r in records]


def compare(spark, con, name, fn, sql, sf_dir):
    """(ok, message)"""
    t0 = time.time()
    df = fn(spark, sf_dir)
    got_names, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    t1 = time.time()
    if sql is None:
        return len(got) > 0, f"rows={len(got)} spark={t1 - t0:.1f}s (no SQL)"
    cur = con.execute(sql)
    want_names, want = rows_of([d[0] for d in cur.description], cur.fetchall())
    t2 = time.time()
    took = f"rows={len(got)} spark={t1 - t0:.1f}s sql={t2 - t1:.1f}s"
    if got_names != want_names:
        return False, f"{took} columns {got_names} != {want_names}"
    if len(got) != len(want):
        return False, f"{took} rows {len(got)} != {len(want)}"
    key = lambda r: tuple((x is None, type(x).__name__, x if x is not None else 0) for x in r)
    got, want = sorted(got, key=key), sorted(want, key=key)
    for g, w in zip(got, want):
        if g != w or [family_of(x) for x in g] != [family_of(x) for x in w]:
            diff = [(n, a, b) for n, a, b in zip(got_names, g, w) if a != b or family_of(a) != family_of(b)]
            return False, f"{took} differs: {str(diff)[:600]}"
    return True, took


def main(argv):
    sys.path.insert(0, ".")
    import __spark_entry__ as entry
    from tests.conftest import make_session

    sf = "/root/testdata/sf0.01"
    if argv and argv[0].startswith("/"):
        sf, argv = argv[0], argv[1:]
    spark = make_session()
    con = connect(sf)
    queries, sqls = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in argv or queries:
        try:
            ok, msg = compare(spark, con, name, queries[name], sqls.get(name), sf)
        except Exception as e:  # report and go on with the next query
            ok, msg = False, f"{type(e).__name__}: {str(e)[:700]}"
        bad += not ok
        print("ok  " if ok else "FAIL", name, msg, flush=True)
    print(f"{bad} of {len(argv or queries)} failed")


if __name__ == "__main__":
    main(sys.argv[1:])
