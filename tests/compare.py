"""Run registered queries against their SQL counterparts."""

from __future__ import annotations

import math
import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
DATA = os.environ.get("QUAKESPARK_TESTDATA", "/root/testdata/sf0.001")


def database(folder: str = DATA):
    con = duckdb.connect()
    for name in TABLES.split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, float):
        return value + 0.0
    return value


def _key(row):
    return tuple((v is None, str(type(v)), v if v is not None else 0) for v in row)


def spark_rows(df):
    names = sorted(df.columns)
    return names, sorted((tuple(_cell(r[n]) for n in names) for r in df.collect()), key=_key)


def sql_rows(con, sql):
    cur = con.execute(sql)
    found = [d[0] for d in cur.description]
    names = sorted(found)
    order = [found.index(n) for n in names]
    return names, sorted((tuple(_cell(r[i]) for i in order) for r in cur.fetchall()), key=_key)


def differences(got, want, limit=3):
    """Text of what differs, empty when both are equal."""
    (names, rows), (names2, rows2) = got, want
    if names != names2:
        return f"columns {names} != {names2}"
    if len(rows) != len(rows2):
        return f"{len(rows)} rows != {len(rows2)}; first {rows[:1]} / {rows2[:1]}"
    bad = [(a, b) for a, b in zip(rows, rows2) if a != b]
    return f"{len(bad)} of {len(rows)} rows differ: {bad[:limit]}" if bad else ""
