"""Compare registered queries with their SQL twins: python tests/oracle.py [sf_dir] [name ...]"""

from __future__ import annotations

import decimal
import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def norm(v):
    if v is None:
        return "~"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        return "~nan" if math.isnan(v) else repr(round(v, 6))
    if isinstance(v, decimal.Decimal):
        return format(v.normalize(), "f")
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(norm(x) for x in v) + "]"
    if isinstance(v, dict):
        return "{" + ",".join(f"{k}:{norm(x)}" for k, x in sorted(v.items())) + "}"
    return str(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(norm(r[i]) for i in order) for r in rows)


def compare(spark, con, name, query, sql, sf_dir):
    """None when equal, else a short description of the difference."""
    t0 = time.time()
    df = query(spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    took = time.time() - t0
    if sql is None:
        return took, len(got), None
    cur = con.execute(sql)
    want_cols = [d[0] for d in cur.description]
    a, b = rows_of(df.columns, got), rows_of(want_cols, cur.fetchall())
    if a[0] != b[0]:
        return took, len(got), f"columns {a[0]} != {b[0]}"
    if a[1] != b[1]:
        only_a = [x for x in a[1] if x not in set(b[1])][:3]
        only_b = [x for x in b[1] if x not in set(a[1])][:3]
        return took, len(got), f"rows {len(a[1])} vs {len(b[1])}; spark only {only_a}; sql only {only_b}"
    return took, len(got), None


def main(argv):
    import __spark_entry__ as entry
    from kgspark.session import local_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    queries, sqls = entry.queries(), entry.oracle_sql()
    names = [n for n in queries if not argv[1:] or any(n.startswith(p) for p in argv[1:])]
    bad = 0
    for n in names:
        try:
            took, rows, diff = compare(spark, con, n, queries[n], sqls.get(n), sf_dir)
        except Exception as e:  # noqa: BLE001
            took, rows, diff = 0, 0, "ERROR " + str(e)[:1500]
        state = "ok  " if diff is None else "FAIL"
        bad += diff is not None
        note = "" if n in sqls else " (no sql)"
        empty = " EMPTY" if rows == 0 else ""
        print(f"{state} {n} {rows} rows {took:.1f}s{note}{empty}" + (f"\n     {diff}" if diff else ""), flush=True)
    print(f"{len(names)} queries, {bad} failing")
    return bad


if __name__ == "__main__":
    sys.exit(min(main(sys.argv[1:]), 100))
