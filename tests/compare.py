"""Runs registered queries against their checking SQL.

``python tests/compare.py [key ...] [--sf DIR]`` prints one line per key.
"""

from __future__ import annotations

import datetime
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from paralex.plans.fixtures import TABLES  # noqa: E402

SF = os.environ.get("PARALEX_SF_DIR", "/root/testdata/sf0.01")


def connect(sf: str = SF) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.12g}")
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def table_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    data = sorted((tuple(plain(r[i]) for i in order) for r in rows), key=lambda r: tuple(map(repr, r)))
    return names, data


def spark_side(df):
    return table_of(df.columns, [tuple(r) for r in df.collect()])


def duck_side(con, sql):
    cur = con.execute(sql)
    return table_of([d[0] for d in cur.description], cur.fetchall())


def differences(left, right) -> str | None:
    if left[0] != right[0]:
        return f"columns {left[0]} != {right[0]}"
    if len(left[1]) != len(right[1]):
        extra = [r for r in left[1] if r not in set(right[1])][:2], [r for r in right[1] if r not in set(left[1])][:2]
        return f"rows {len(left[1])} != {len(right[1])}: {str(extra)[:1500]}"
    for a, b in zip(left[1], right[1]):
        if a != b:
            bad = [(n, x, y) for n, x, y in zip(left[0], a, b) if x != y]
            return f"first difference {str(bad)[:1500]} in {str(a)[:300]}"
    return None


def main(argv: list[str]) -> int:
    from paralex.plans import catalog
    from paralex.session import local_session

    sf = SF
    if "--sf" in argv:
        at = argv.index("--sf")
        sf = argv[at + 1]
        del argv[at : at + 2]
    spark, con = local_session("8"), connect(sf)
    runs, checks = catalog.queries(), catalog.oracle_sql()
    failed = 0
    for key in argv or list(runs):
        try:
            t0 = time.time()
            left = spark_side(runs[key](spark, sf))
            t1 = time.time()
            if key not in checks:
                print(f"ROWS {key}: {len(left[1])} rows, spark {t1 - t0:.2f}s", flush=True)
                continue
            right = duck_side(con, checks[key])
            note = differences(left, right)
            t2 = time.time()
            failed += note is not None
            print(f"{'FAIL' if note else 'ok  '} {key}: {len(left[1])} rows, spark {t1 - t0:.2f}s, check {t2 - t1:.2f}s {note or ''}", flush=True)
        except Exception as e:  # report and go on with the next key
            failed += 1
            print(f"ERR  {key}: {str(e)[:1500]}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
