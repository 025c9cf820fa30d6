"""Run queries and their SQL on the same files and report where results differ.

Usage: python -m bindings.compare <folder> [name-prefix ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time

import duckdb

from bindings.base import ORACLE, QUERIES, TABLES


def plain(value):
    if value is None:
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else value
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    body = [tuple(plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(body, key=lambda r: tuple((v is None, str(type(v)), str(v)) for v in r))


def sql_engine(folder: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def check(spark, con, folder: str, name: str) -> str | None:
    """None when equal, else a short account of the difference."""
    frame = QUERIES[name](spark, folder)
    got = table(frame.columns, [tuple(r) for r in frame.collect()])
    if name not in ORACLE:
        return None if got[1] else "no rows"
    cur = con.execute(ORACLE[name])
    want = table([d[0] for d in cur.description], cur.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    if len(got[1]) != len(want[1]):
        return f"rows {len(got[1])} != {len(want[1])}; first {got[1][:2]} / {want[1][:2]}"
    bad = [(a, b) for a, b in zip(got[1], want[1]) if a != b]
    if bad:
        return f"{len(bad)} of {len(got[1])} rows differ: {got[0]}\n   spark {bad[0][0]}\n   sql   {bad[0][1]}"
    if not got[1]:
        return "equal but empty"
    kinds = [(c, {type(r[i]).__name__ for r in got[1]} - {"NoneType"}, {type(r[i]).__name__ for r in want[1]} - {"NoneType"})
             for i, c in enumerate(got[0])]
    odd = [k for k in kinds if k[1] != k[2]]
    return f"types differ: {odd}" if odd else None


def main(folder: str, prefixes: list[str]) -> int:
    import bindings.all  # noqa: F401
    from crosswalk.session import local_session

    spark, con, failed = local_session(), sql_engine(folder), []
    names = [n for n in QUERIES if not prefixes or any(n.startswith(p) for p in prefixes)]
    for name in names:
        start = time.time()
        try:
            problem = check(spark, con, folder, name)
        except Exception as error:  # report and go on with the other queries
            problem = f"{type(error).__name__}: {str(error)[:700]}"
        took = time.time() - start
        print(f"{'FAIL' if problem else 'ok  '} {took:6.2f}s {name} {'' if name in ORACLE else '(no sql)'} {problem or ''}", flush=True)
        if problem:
            failed.append(name)
    print(f"{len(names) - len(failed)} of {len(names)} equal; failed: {failed}")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
