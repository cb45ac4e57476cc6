"""Runs a query on Spark and its SQL on DuckDB and compares names, types and values."""

from __future__ import annotations

import datetime as dt
import decimal
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        return ("num", value.normalize() + 0)
    if isinstance(value, bool) or value is None or isinstance(value, str):
        return value
    if isinstance(value, float):
        return ("num", round(value, 9))
    if isinstance(value, int):
        return ("num", value)
    if isinstance(value, dt.datetime):
        return ("time", value.replace(tzinfo=None).isoformat())
    return ("other", str(value))


def bag(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in rows)


KINDS = {
    "int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN",
    "date": "DATE", "timestamp": "TIMESTAMP WITH TIME ZONE", "timestamp_ntz": "TIMESTAMP",
}


def compare(spark, folder, name, build, sql, con=None):
    """An empty list when equal, else what differs."""
    con = con or connect(folder)
    ours = build(spark, folder)
    described = {row[0]: row[1] for row in con.execute(f"DESCRIBE {sql}").fetchall()}
    their_names = list(described)
    found = []
    if sorted(ours.columns) != sorted(their_names):
        return [f"columns {sorted(ours.columns)} / {sorted(their_names)}"]
    for column, kind in ours.dtypes:
        expected = KINDS.get(kind, kind.upper().replace(" ", ""))
        if described[column].replace(" ", "") != expected.replace(" ", ""):
            found.append(f"type {column}: {kind} / {described[column]}")
    left, right = bag(ours.columns, ours.collect()), bag(their_names, con.execute(sql).fetchall())
    if left != right:
        found.append(f"rows {sum(left.values())} / {sum(right.values())}")
        found.append(f"only ours {list((left - right).items())[:2]}")
        found.append(f"only theirs {list((right - left).items())[:2]}")
    return found
