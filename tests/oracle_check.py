"""Compare every query with its SQL: `python tests/oracle_check.py [sf_dir] [name ...]`."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _plain(value):
    if value is None or isinstance(value, (str, bool, int)):
        return value
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if hasattr(value, "isoformat"):
        return value.isoformat()
    return str(value)


def _order(row):
    return [(v is None, type(v).__name__, v if v is not None else 0) for v in row]


def compare(spark, con, build, sql: str, sf_dir: str) -> str:
    """Empty where both sides agree, else what differs."""
    got = build(spark, sf_dir)
    names = sorted(got.columns)
    left = [[_plain(v) for v in r] for r in got.select(*[f"`{n}`" for n in names]).collect()]
    cursor = con.execute(sql)
    have = [d[0] for d in cursor.description]
    if sorted(have) != names:
        return f"columns {names} against {sorted(have)}"
    places = [have.index(n) for n in names]
    right = [[_plain(r[i]) for i in places] for r in cursor.fetchall()]
    if len(left) != len(right):
        return f"{len(left)} rows against {len(right)}"
    left.sort(key=_order)
    right.sort(key=_order)
    for a, b in zip(left, right):
        if a != b:
            return f"{names}: {str(a)[:400]} against {str(b)[:400]}"
    return ""


def main(argv: list[str]) -> int:
    from __spark_entry__ import oracle_sql, queries
    from millrace.session import local_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark, con = local_session("8"), connect(sf_dir)
    oracle, bad = oracle_sql(), 0
    for name, build in queries().items():
        if argv[1:] and name not in argv[1:]:
            continue
        began = time.time()
        try:
            if name in oracle:
                problem = compare(spark, con, build, oracle[name], sf_dir)
            else:
                problem = "" if build(spark, sf_dir).count() else "no rows"
        except Exception as failure:
            problem = f"{type(failure).__name__}: {str(failure)[:1500]}"
        bad += bool(problem)
        print(f"{'BAD ' if problem else 'ok  '} {name} {time.time() - began:.1f}s {problem}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
