"""Compare registered queries with their SQL in DuckDB.

Run as a script: ``python tests/oracle.py [sf dir] [query ...]``.
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6)
    return value


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(plain(r[i]) for i in order) for r in rows]
    return sorted(columns), sorted(out, key=repr)


def compare(spark, con, name, query, sf_dir):
    """Empty string if equal, else what differs."""
    df = query.build(spark, sf_dir)
    got_columns, got = canonical(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(query.sql)
    types = {d[0]: str(d[1]) for d in result.description}
    columns, want = canonical([d[0] for d in result.description], result.fetchall())
    if got_columns != columns:
        return f"columns {got_columns} != {columns}"
    if len(got) != len(want):
        return f"{len(got)} rows, expected {len(want)}; first {got[:2]} / {want[:2]}"
    for a, b in zip(got, want):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return f"row {a} != {b} in {columns} {types}"
    return ""


if __name__ == "__main__":
    root = Path(__file__).resolve().parent.parent
    sys.path.insert(0, str(root))
    from concord.queries import REGISTRY
    from concord.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(REGISTRY)
    spark = build_session(
        "local[8]",
        spark__sql__shuffle__partitions="8",
        spark__ui__enabled="false",
        spark__driver__host="127.0.0.1",
        spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf)
    bad = 0
    for name in names:
        start, q = time.time(), REGISTRY[name]
        try:
            if q.sql is None:
                verdict = f"rows only: {q.build(spark, sf).count()}"
            else:
                verdict = compare(spark, con, name, q, sf)
                bad += bool(verdict)
                verdict = f"DIFFERS {verdict[:900]}" if verdict else "ok"
        except Exception as e:  # noqa: BLE001
            bad += 1
            verdict = f"ERROR {type(e).__name__} {str(e)[:900]}"
        print(f"{name:28s} {time.time() - start:6.1f}s {verdict}", flush=True)
    print("failures:", bad)
