"""Run a query on Spark and its SQL on an independent engine, and compare the rows."""

from __future__ import annotations

import math
import os
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def sql_rows(sf_dir: str, sql: str) -> list[dict]:
    con = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{sf_dir}/{t}.parquet"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    assert len(set(names)) == len(names), f"a column comes twice: {names}"
    return [dict(zip(names, r)) for r in cursor.fetchall()]


def plain(value):
    if isinstance(value, bool):
        return int(value)
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else (0.0 if value == 0 else value)
    return value


def canonical(rows: list[dict]) -> list[tuple]:
    out = [tuple((k, plain(r[k])) for k in sorted(r)) for r in rows]
    return sorted(out, key=lambda r: tuple((k, v is None, str(type(v)), v if v is not None else 0) for k, v in r))


def differences(left: list[dict], right: list[dict], limit: int = 3) -> list:
    a, b = canonical(left), canonical(right)
    if len(a) != len(b):
        return [f"{len(a)} rows against {len(b)}"] + [x for x in zip(a[:limit], b[:limit])]
    return [(x, y) for x, y in zip(a, b) if x != y][:limit]
