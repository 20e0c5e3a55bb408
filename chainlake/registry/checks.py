"""Side-by-side run of registered queries and their SQL, as the driver does it."""

from __future__ import annotations

import math
import time
from datetime import date, datetime
from decimal import Decimal

import duckdb

from chainlake.registry.adapters import BASE


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in BASE:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if isinstance(value, Decimal):
        return int(value) if value == value.to_integral_value() else float(value)
    if isinstance(value, datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, date):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return [_plain(v) for v in value]
    return value


def canonical(names: list[str], rows: list) -> list:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(repr([_plain(r[i]) for i in order]) for r in rows)


def compare(spark, con, folder, build, sql) -> tuple[bool, str]:
    start = time.time()
    df = build(spark, folder)
    got = [tuple(r) for r in df.collect()]
    spent = time.time() - start
    if sql is None:
        return True, f"{len(got)} rows, no SQL, {spent:.1f}s"
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = cur.fetchall()
    if sorted(names) != sorted(df.columns):
        return False, f"columns {sorted(df.columns)} != {sorted(names)}"
    a, b = canonical(df.columns, got), canonical(names, want)
    if a == b:
        return True, f"{len(got)} rows, {spent:.1f}s"
    only_a, only_b = sorted(set(a) - set(b))[:2], sorted(set(b) - set(a))[:2]
    return False, f"{len(got)} vs {len(want)} rows\n   spark {only_a}\n   sql   {only_b}"
