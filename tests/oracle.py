"""Runs registered queries next to their SQL twins: ``python tests/oracle.py [-f folder] [name...]``."""

from __future__ import annotations

import argparse
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


def plain(value):
    """A comparable form: floats rounded, numbers unified, nested values as tuples."""
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6) + 0.0
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    if isinstance(value, dict):
        return tuple((k, plain(v)) for k, v in value.items())
    if hasattr(value, "asDict"):
        return plain(value.asDict())
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def connect(folder):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def compare(spark, con, folder, run, sql):
    """(problem or None, row count)."""
    df = run(spark, folder)
    begun = time.time()
    got = rows_of(df.columns, df.collect())
    compare.seconds = time.time() - begun
    if not sql:
        return None, len(got)
    answer = con.execute(sql)
    names = [d[0] for d in answer.description]
    want = rows_of(names, answer.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}", len(got)
    if got != want:
        extra = [r for r in got if r not in set(want)][:3]
        lost = [r for r in want if r not in set(got)][:3]
        return f"rows {len(got)} != {len(want)}; only Spark {extra}; only SQL {lost}", len(got)
    return None, len(got)


compare.seconds = 0.0


def main():
    from __spark_entry__ import oracle_sql, queries
    from slotloom.session import local_session

    parser = argparse.ArgumentParser()
    parser.add_argument("-f", "--folder", default="/root/testdata/sf0.001")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    spark = local_session()
    con = connect(args.folder)
    runs, sqls = queries(), oracle_sql()
    bad = 0
    for name, run in runs.items():
        if args.names and not any(name.startswith(n) for n in args.names):
            continue
        begun = time.time()
        try:
            problem, n = compare(spark, con, args.folder, run, sqls.get(name))
        except Exception as error:  # shown, and counted as a failure
            problem, n = f"{type(error).__name__}: {str(error)[:1500]}", -1
        bad += problem is not None
        kind = "sql " if name in sqls else "rows"
        print(f"{'FAIL' if problem else 'ok  '} {kind} {name:28s} {n:8d} rows {compare.seconds:6.1f}s of {time.time() - begun:6.1f}s {problem or ''}"[:2500], flush=True)
    spark.stop()
    print("failures:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
