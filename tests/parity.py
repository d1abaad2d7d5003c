"""Compare catalogue queries with their SQL: ``python tests/parity.py [sf_dir] [query ...]``."""

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def oracle_connection(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _value(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_value(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(out, key=repr)


def compare(df, con, sql):
    """Return a list of differences, empty when both sides agree exactly."""
    ours = rows_of(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    theirs = rows_of([d[0] for d in result.description], result.fetchall())
    if ours[0] != theirs[0]:
        return [f"columns {ours[0]} != {theirs[0]}"]
    if len(ours[1]) != len(theirs[1]):
        return [f"rows {len(ours[1])} != {len(theirs[1])}"]
    return [f"{a} != {b}" for a, b in zip(ours[1], theirs[1]) if a != b]


if __name__ == "__main__":
    from __spark_entry__ import oracle_sql, queries
    from digestloom.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(queries())
    spark, con, sql = local_session(), oracle_connection(sf_dir), oracle_sql()
    bad = 0
    for name in names:
        t = time.time()
        try:
            df = queries()[name](spark, sf_dir)
            diff = compare(df, con, sql[name]) if name in sql else [] if df.count() >= 0 else []
        except Exception as exc:  # report and go on with the next query
            diff = [str(exc)[:1500]]
        bad += bool(diff)
        print(f"{'FAIL' if diff else 'ok  '} {name} {time.time() - t:.1f}s", flush=True)
        for line in diff[:3]:
            print("     ", line[:1200], flush=True)
    print("failures:", bad)
