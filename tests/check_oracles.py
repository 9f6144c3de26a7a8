"""Run registered queries and their SQL twins side by side: ``python tests/check_oracles.py [sf] [name…]``."""

from __future__ import annotations

import decimal
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def plain(value):
    if value is None:
        return "~"
    if isinstance(value, bool):
        return f"b:{value}"
    if isinstance(value, decimal.Decimal):
        return f"d:{value}"
    if isinstance(value, float):
        return f"f:{value!r}"
    return f"{type(value).__name__}:{value}"


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(plain(r[i]) for i in order) for r in rows)


def run_sql(sf_dir, sql):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    cur = con.execute(sql)
    return canonical([d[0] for d in cur.description], cur.fetchall())


def compare(spark, sf_dir, name, fn, sql):
    """None when equal, else a short account of the first difference."""
    df = fn(spark, sf_dir)
    got = canonical(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return None, len(got[1])
    want = run_sql(sf_dir, sql)
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}", len(got[1])
    if got[1] != want[1]:
        g, w = set(got[1]), set(want[1])
        a, b = sorted(g - w)[:2], sorted(w - g)[:2]
        return f"rows {len(got[1])} vs {len(want[1])}\n   spark {str(a)[:700]}\n   sql   {str(b)[:700]}", len(got[1])
    return None, len(got[1])


def main():
    from catalogspark.plans import load
    from catalogspark.session import local_session

    args = sys.argv[1:]
    sf = args.pop(0) if args and args[0].startswith("0.") else "0.01"
    spark = local_session()
    spark.sparkContext.setLogLevel("OFF")
    queries, oracles = load()
    bad = 0
    for name, fn in queries.items():
        if args and not any(a in (name, fn.__module__.rsplit(".", 1)[-1]) for a in args):
            continue
        t = time.time()
        try:
            diff, n = compare(spark, f"/root/testdata/sf{sf}", name, fn, oracles.get(name))
        except Exception as e:  # noqa: BLE001 - reported per query
            diff, n = f"{type(e).__name__}: {str(e)[:400]}", -1
        bad += diff is not None
        mark = "ok " if diff is None else "BAD"
        twin = "" if name in oracles else " (no sql)"
        print(f"{mark} {name:34s} rows={n} {time.time() - t:.2f}s{twin}", flush=True)
        if diff:
            print("   " + diff, flush=True)
    print("bad:", bad)
    spark.stop()


if __name__ == "__main__":
    main()
