"""Run a registered query on Spark and its SQL on DuckDB, compare the rows."""

from __future__ import annotations

import datetime
import math
import os
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

SPARK_TO_DUCK = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "float": "FLOAT", "string": "VARCHAR",
    "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP", "date": "DATE",
    "smallint": "SMALLINT", "tinyint": "TINYINT",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{os.path.join(sf_dir, name)}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return repr(value + 0.0)
    if isinstance(value, Decimal):
        return str(value)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, (list, tuple)):
        return str([_plain(v) for v in value])
    return str(value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def compare(df, con, sql: str) -> str | None:
    """None when equal, otherwise a short account of the first difference."""
    cur = con.execute(sql)
    want_cols = [d[0] for d in cur.description]
    want_types = {d[0]: str(d[1]) for d in cur.description}
    want = cur.fetchall()
    got = df.collect()
    if sorted(df.columns) != sorted(want_cols):
        return f"columns {sorted(df.columns)} != {sorted(want_cols)}"
    for field, dtype in df.dtypes:
        expected = SPARK_TO_DUCK.get(dtype)
        if expected and want_types[field] != expected:
            return f"type of {field}: {dtype} against {want_types[field]}"
        if expected is None and not dtype.startswith("array"):
            return f"type of {field}: {dtype} is not comparable"
    a, b = _rows(df.columns, got), _rows(want_cols, want)
    if len(a) != len(b):
        return f"{len(a)} rows against {len(b)}; spark {a[:2]} oracle {b[:2]}"
    for x, y in zip(a, b):
        if x != y:
            diff = sum(1 for p, q in zip(a, b) if p != q)
            return f"{diff} rows differ; spark {x} oracle {y}"
    return None
