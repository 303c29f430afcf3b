"""Run registered queries against their SQL and report every difference.

    python tests/check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime
import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def kind_of(name: str) -> str:
    n = name.lower()
    for kind, words in {
        "int": ("bigint", "int", "long", "smallint", "hugeint"),
        "float": ("double", "float", "decimal"),
        "text": ("string", "varchar"),
        "bool": ("boolean",),
        "time": ("timestamp",),
        "date": ("date",),
    }.items():
        if n.startswith(words):
            return kind
    return n


def compare(spark, con, q, sf_dir: str) -> str | None:
    """None when equal, else a short text."""
    df = q.build(spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    if q.oracle is None:
        return None if got is not None else "no rows"
    cur = con.execute(q.oracle)
    names = [d[0] for d in cur.description]
    kinds = {d[0]: kind_of(str(d[1])) for d in cur.description}
    want = cur.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    odd = [f"{c}: {t} != {kinds[c]}" for c, t in df.dtypes if kind_of(t) != kinds[c]]
    left, right = rows_of(df.columns, got), rows_of(names, want)
    if left != right:
        in_left, in_right = set(left), set(right)
        only_l = [r for r in left if r not in in_right][:2]
        only_r = [r for r in right if r not in in_left][:2]
        return f"rows {len(left)}/{len(right)}\n   spark {only_l}\n   sql   {only_r}\n   cols {sorted(names)}"
    if odd:
        return f"types {odd}"
    return None if left else "EMPTY on both sides"


def main() -> int:
    from postline.plans import load
    from postline.session import build_session

    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and "/" in args[0] else "/root/testdata/sf0.01"
    queries = load()
    wanted = [q for q in queries.values() if not args or any(q.name.startswith(a) for a in args)]
    spark = build_session()
    con = connect(sf_dir)
    bad = 0
    for q in wanted:
        start = time.time()
        try:
            problem = compare(spark, con, q, sf_dir)
        except Exception as e:  # report and go on
            problem = f"{type(e).__name__}: {str(e)[:900]}"
        took = time.time() - start
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'BAD '} {q.name} {took:.1f}s {'' if q.oracle else '(rows)'} {problem or ''}", flush=True)
    print(f"{len(wanted)} queries, {bad} bad")
    return bad


if __name__ == "__main__":
    raise SystemExit(main() > 0)
